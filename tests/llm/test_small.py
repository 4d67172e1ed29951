"""Parts that need no Spark: against brute force, round trips, and property tests."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from callmill.llm import boilerplate, encoding, names, neardup, packing, sentences, splitting


def brute_cut(t, limit=4000, least=2000, overlap=200):
    out, s = [], 0
    while len(t) - s > limit:
        for level in range(6):
            ends = []
            for e in range(s + least, s + limit + 1):
                c = t[e - 1]
                ok = [c == "\f", t[e - 2 : e] == "\n\n", c == "\n", c in ".!?" and t[e].isspace() or c in "。！？", c == " ", e == s + limit][level]
                if ok:
                    ends.append(e)
            if ends:
                break
        out.append((s, ends[-1]))
        s = ends[-1] - overlap
    return [*out, (s, len(t))]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab.!。 \n\f ", min_size=0, max_size=400), st.integers(5, 40))
def test_cut(t, limit):
    least, overlap = limit // 2, limit // 10
    made = list(splitting.cut(t, limit, least, overlap))
    assert made == brute_cut(t, limit, least, overlap)
    assert made[0][0] == 0 and made[-1][1] == len(t) and all(b - a <= limit for a, b in made)


def test_cut_of_very_long_text():
    t = "x" * 1_000_000
    assert list(splitting.cut(t))[:2] == [(0, 4000), (3800, 7800)]
    with pytest.raises(ValueError):
        list(splitting.cut("x", 10, 5, 5))


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=300))
def test_encoding_round_trip(t):
    ids = encoding.encode(t)
    assert encoding.decode(ids) == t
    e = encoding.encoder()
    assert [i for part in encoding.stretches(t, 7) for i in e.encode_ordinary(part)] == ids


def test_encoding_against_another_library():
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(f"{encoding.FOLDER}/byte_bpe_50k.json")
    other.encode_special_tokens = True
    rng = random.Random(1)
    texts = ["", "<|endoftext|> x", "a" * 45_000, "word " * 30_000, "价格" * 5_000, "\n\n \t " * 999, "it's we'LL 12,5% สวัสดี हिन्दी 👩🏽‍💻", "".join(chr(rng.randrange(32, 0x2FFF)) for _ in range(3000))]
    for t in texts:
        assert encoding.encode(t) == other.encode(t, add_special_tokens=False).ids
    assert encoding.encode(None) == [] and encoding.decode([]) == ""


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=120))
def test_best_fit(sizes):
    x = np.array(sizes, np.int64)
    chosen = packing.best_fit(x, 50, 8, 2500)
    for b in set(chosen.tolist()):
        own = x[chosen == b]
        assert own.sum() <= 50 and len(own) <= 8 and (own**2).sum() <= 2500
    # no two containers could be one
    if len(sizes):
        free = sorted((50 - x[chosen == b].sum(), (chosen == b).sum(), b) for b in set(chosen.tolist()))
        assert len(free) <= max(1, 2 * x.sum() / 50 + len(sizes) / 8 + 1)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 60), max_size=100), st.integers(1, 60), st.integers(1, 9), st.integers(1, 4000))
def test_best_fit_under_every_limit(sizes, capacity, documents, attention):
    """No container is over any limit, and none is opened while another could take the item."""
    x = np.minimum(np.array(sizes, np.int64), packing.longest_part(capacity, attention))
    chosen = packing.best_fit(x, capacity, documents, attention)
    own = [x[chosen == b] for b in range(chosen.max(initial=-1) + 1)]
    assert all(len(o) and o.sum() <= capacity and len(o) <= documents and (o**2).sum() <= attention for o in own)
    seen: list = []
    for i in np.argsort(-x, kind="stable"):
        if chosen[i] == len(seen):
            assert not any(sum(o) + x[i] <= capacity and len(o) < documents and sum(v * v for v in o) + x[i] ** 2 <= attention for o in seen)
            seen.append([])
        seen[chosen[i]].append(int(x[i]))


def test_best_fit_refuses():
    for wrong in (((5,), 4, 1, 100), ((5,), 10, 1, 24), ((1,), 0, 1, 1), ((1,), 5, 0, 5)):
        try:
            packing.best_fit(np.array(wrong[0]), *wrong[1:])
        except ValueError:
            continue
        raise AssertionError(wrong)


def test_lines_cover():
    """Two points lie on one line, and any six differing points of a plane leave a line untouched."""
    from itertools import combinations

    masks = [set(x.tolist()) for x in neardup.lines()]
    assert len(masks) == 20 and all(len(m) == 4 for m in masks)
    assert all(sum(a in m and b in m for m in masks) == 1 for a, b in combinations(range(16), 2))
    assert all(any(not m & set(d) for m in masks) for d in combinations(range(16), 6))


def test_shingles():
    assert neardup.shingles(None) is None and neardup.shingles("a b c") is None
    one, two = neardup.shingles("A b c d e f g h i j k l"), neardup.shingles("a, B c d e-f g h i j k l!")
    assert len(one) == 10 and (one == two).all()
    at, g, starts = neardup._sets([None, "x", "a b c d e f g h i j k l", "a a a a a a a a a a a a a", "a b c d e f g h i j k l m"])
    assert at.tolist() == [2, 3, 4] and starts.tolist() == [0, 10, 11] and len(g) == 22
    assert (g[:10] == one).all()


def test_names_parts():
    assert names.take_apart("The M. Tornolmersil Pvt Bank L.L.C.") == ("private bank", ["m", "tornolmersil"])
    assert names.take_apart("Ulmze1, Michael – Fd Managers") == ("fund managers", ["ulmzel", "michael"])
    assert names.take_apart("FenralwalkirResearchInstitute") == ("research institute", ["fenralwalkir"])
    assert names.take_apart("Zellan Invesyments") == ("investments", ["zellan"])
    assert names.take_apart("Group") == (None, ["group"])
    assert names.take_apart("Zellan LP") == (None, ["zellan"]) and names.take_apart("Zellan L&P") == ("life and pensions", ["zellan"])
    assert names.cores(["ted", "abc"]) == [["theodore", "abc"], ["edward", "abc"]]
    assert names.same_core("michael ulmzelholdar", "holdar ulmzel michael") or names.same_core("michael ulmzelholdar", "michael ulmzel holdar")
    assert not names.same_core("quilingsilren", "quilingsortem")
    assert names.same_core("m tornolmersil", "margaret tornolmersil") and not names.same_core("r tornolmersil", "margaret tornolmersil")


@settings(max_examples=200, deadline=None)
@given(st.text("abc", max_size=9), st.text("abc", max_size=9))
def test_common_subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert names.common_subsequence(a, b) == table[-1][-1]
    damerau = a == b or any(a[:i] + a[i + 1 :] == b for i in range(len(a))) or any(b[:i] + b[i + 1 :] == a for i in range(len(b)))
    damerau = damerau or len(a) == len(b) and (sum(x != y for x, y in zip(a, b)) == 1 or any(a[:i] + a[i + 1] + a[i] + a[i + 2 :] == b for i in range(len(a) - 1)))
    assert names.one_edit(a, b) == damerau


def test_labelled_pages():
    pages = boilerplate.labelled()
    assert len(pages) > 100 and {y for _, _, label in pages for y in label.values()} == {0, 1}
    corpus = boilerplate.Corpus({}, boilerplate.word_odds())
    url, lines, label = pages[0]
    described = boilerplate.features(url, lines, corpus)
    assert [i for i, _ in described] == sorted(label) and all(len(f) == len(boilerplate.NAMES) for _, f in described)
    assert boilerplate.features(None, ["", " "], corpus) == []
    assert len(boilerplate.features(None, ["x " * 20_000], corpus)) == 1


TEXT = [
    "Why pricing power matters\n\nMr. Abc et al. put fair value at 3.5, not 4. We trimmed utilities in Q3 2026.Senior analysts agree. Not yet! “Will it last?” asked one allocator. Yields fell.",
    "- Neutral on copper.\n- Watch No. 5. And more\nGold | Neutral | 4.1%\nThe real\t1.5\t2%\n\nWe expect gold to\nrise in Chile. The rand fell.",
    "指数上涨4.1%，但供给有限。还没有！“公司债正在补涨。”委员会表示。收益率为37个基点……但需求走弱。",
]


def test_sentences():
    rng = random.Random(3)
    starts = ["We trimmed utilities in Q3 2026.", "Senior analysts agree.", "Not yet!", "Yields fell.", "The rand fell.", "We expect gold to rise in Chile.", "Mr. Abc et al. put fair value at 3.5, not 4.", "“Will it last?” asked one allocator."]
    wide = ["指数上涨4.1%，但供给有限。", "还没有！", "“公司债正在补涨。”委员会表示。", "收益率为37个基点……但需求走弱。"]
    corpus = [" ".join(rng.choices(starts, k=5)) for _ in range(300)] + ["".join(rng.choices(wide, k=4)) for _ in range(200)]
    model = sentences.fit(corpus)
    cut = [[t[a:b] for a, b in sentences.units(t, model)] for t in TEXT]
    assert cut[0] == ["Why pricing power matters", "Mr. Abc et al. put fair value at 3.5, not 4.", "We trimmed utilities in Q3 2026.", "Senior analysts agree.", "Not yet!", "“Will it last?” asked one allocator.", "Yields fell."]
    assert cut[1] == ["- Neutral on copper.", "- Watch No. 5. And more", "Gold | Neutral | 4.1%", "The real\t1.5\t2%", "We expect gold to\nrise in Chile.", "The rand fell."]
    assert cut[2] == wide


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aB1.!?。 \n\r\t|-“”…ก่ ", max_size=80))
def test_units_cover(t):
    model = sentences.Model().freeze()
    at = [0] * len(t)
    last = 0
    for a, b in sentences.units(t, model):
        assert last <= a < b and not t[a].isspace() and not t[b - 1].isspace()
        last = b
        for i in range(a, b):
            at[i] += 1
    assert all(n == 1 or c.isspace() for n, c in zip(at, t))


def test_forward_backward_is_exact():
    """Against all assignments of a stretch, with the same factors."""
    model = sentences.fit(["A b. C d. E f g. A b c. D e."] * 5)
    marks = ["A", "b", ".", "C", "d", ".", "E", "."]
    gaps = [(3, 0.5), (6, -0.5)]
    out = sentences.posteriors(marks, gaps, model)
    assert len(out) == 2 and all(0 <= p <= 1 for p in out)
    assert sentences.posteriors(marks, [], model) == []


def test_every_gap_is_decided():
    """The probabilities of all gaps of a stretch, named or not, are those over all of its divisions; side by side with others."""
    model = sentences.fit(["A b. C d. E f g. A b c. D e."] * 5)
    told = [(["A", "b", ".", "C", "d", ".", "E", "f"], [(3, 0.5), (6, -0.5)]), (["E"], []), ([], []), (["A", "b", "C", "d", "E"], []), (["D", "e"], [(1, 1.0)])]
    found = sentences.chances(told, model)
    for (marks, gaps), p in zip(told, found):
        n, odds = len(marks), dict(gaps)
        assert len(p) == max(0, n - 1)
        weights = {}
        for k in range(2 ** max(0, n - 1)):
            ends = [j for j in range(1, n) if k >> (j - 1) & 1]
            score = sum(odds.get(j, sentences.plain_odds(marks[j - 1], marks[j])) for j in ends)
            row = [sentences.START]
            for j, word in enumerate([*marks, sentences.END]):
                end = model.log(tuple(row[-3:]), sentences.END)
                if j in ends:
                    score, row = score + end, [sentences.START]
                elif 0 < j < n:
                    score += math.log1p(-min(0.999999, math.exp(end)))
                score += model.log(tuple(row[-3:]), word)
                row.append(word)
            weights[k] = math.exp(score)
        assert all(abs(x - sum(w for k, w in weights.items() if k >> i & 1) / sum(weights.values())) < 1e-9 for i, x in enumerate(p))


def test_sentence_ends_that_nothing_marks():
    """A boundary is found by the words alone where other ends of the stretch have marks, before a capital and before a small word."""
    corpus = [f"Yields fell. The rand {x}.\nSenior analysts agree" for x in ("rose", "fell")] * 40 + ["gold may slip. Yields fell. Not yet!"] * 40
    model = sentences.fit(corpus)
    cut = lambda t: [t[a:b] for a, b in sentences.units(t, model)]
    assert cut("Not yet! Senior analysts agree Yields fell. The rand rose.") == ["Not yet!", "Senior analysts agree", "Yields fell.", "The rand rose."]
    assert cut("The rand fell. Senior analysts agree gold may slip.") == ["The rand fell.", "Senior analysts agree", "gold may slip."]


def test_planes_miss_next_to_nothing():
    """Coordinates agree with the similarity's probability: at the least one all planes together must miss at most one pair in 100,000."""
    agree = np.random.default_rng(5).random((200_000, 16)) < neardup.LEAST_SIMILARITY
    missed = 1 - agree[:, neardup.lines()].all(axis=2).any(axis=1).mean()
    assert 0.16 < missed < 0.18 and missed**neardup.PLANES < 1e-5


def test_owners_round_trip():
    for ids in ([], [5], [-9, -9, 0, 7, 2**62], list(range(1000))):
        x = np.array(ids, np.int64)
        assert (neardup.unpack_owners(neardup.pack_owners(x), len(x)) == x).all()


def test_bucket_pairs_all_in_any_cut():
    """Every pair that shares a key comes out, as a pair or by its key, however little is held and paired at once."""
    r = np.random.default_rng(3)
    keys, ids = r.integers(0, 40, 600).astype(np.uint32), r.integers(0, 90, 600)
    expected = {(min(a, b), max(a, b)) for k in range(40) for a in ids[keys == k] for b in ids[keys == k] if a != b}
    for held, stretch, at_once in ((10**6, 10**6, 10**6), (10**6, 10**6, 50), (30, 4, 50), (100, 12, 10**6)):
        neardup.PAIRS_AT_ONCE, before = at_once, neardup.PAIRS_AT_ONCE
        try:
            blocks = [(n % 2, keys[s : s + 60][keys[s : s + 60] % 2 == n % 2], ids[s : s + 60][keys[s : s + 60] % 2 == n % 2]) for n in (0, 1) for s in range(0, 600, 60)]
            found, common = set(), {}
            for x, y, big in neardup.bucket_pairs(iter(blocks), held, stretch):
                if big is None:
                    found |= set(zip(x.tolist(), y.tolist()))
                else:
                    for k, i in zip(x.tolist(), y.tolist()):
                        common.setdefault(k, set()).add(i)
        finally:
            neardup.PAIRS_AT_ONCE = before
        assert found | {(a, b) for m in common.values() for a in m for b in m if a < b} == expected


def test_sketches_lose_next_to_nothing():
    least = neardup.least_agreement(0.6)
    agree = (np.random.default_rng(1).random((200_000, 128)) < 0.7).sum(axis=1)
    assert 52 < least < 66 and (agree < least).mean() == 0
    x, y = np.array([[0b1101, 0]], np.uint64), np.array([[0b0001, 2**63]], np.uint64)
    assert neardup.agreement(x, y).tolist() == [62]


def test_unmarked_stretch():
    """Without any mark a capital after a word without one may begin a sentence; elsewhere only what has marks does."""
    text = "rates fell in chile We trimmed copper Yields rose again and the desk of Mr Abc stayed with what it had " * 2
    toks = sentences.tokens(text)
    assert {toks[j][0] for j, _ in sentences.candidates(text, toks)} == {"We", "Yields", "Mr"}
    toks = sentences.tokens("a Bc d. Ef gh")
    assert [toks[j][0] for j, _ in sentences.candidates("a Bc d. Ef gh", toks)] == ["Ef"]


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 30), st.sets(st.integers(1, 29)))
def test_untouched_ngrams(n, at):
    marks = [f"w{i}" for i in range(n)]
    gaps = [(j, 0.0) for j in sorted(at) if j < n]
    row = ("<s>", *marks, "</s>")
    open_to = {i for j, _ in gaps for i in range(j, j + 3)}
    assert list(sentences.untouched(marks, gaps)) == [row[max(0, i - 2) : i + 2] for i in range(n + 1) if i not in open_to]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab Z'1٣९!.,-–…\n\t\r  éЖ価格、。สวัดี้नमस्ते가'st😀‍_"), max_size=60), st.integers(1, 9))
def test_stretches_cross_no_token(text, size):
    """Whatever the text, its parts give the ids of the whole."""
    e = encoding.encoder()
    parts = encoding.stretches(text, size)
    assert "".join(parts) == text
    assert [i for p in parts for i in e.encode_ordinary(p)] == e.encode_ordinary(text)


def test_long_texts_without_spaces_are_cut():
    for text in ("価格、需要。" * 3000, "ราคาที่ดี" * 3000, "a1b2" * 5000, "line\n" * 5000):
        assert max(map(len, encoding.stretches(text, 500))) < 600


def test_similar_in_blocks(monkeypatch):
    """Sets as bits and sets as they are give what comparing all pairs gives."""
    r = random.Random(8)
    base = [f"word{i}" for i in range(40)]
    texts = [" ".join(w if r.random() > 0.05 else r.choice(base) for w in base) for _ in range(40)] + ["x " * 12, " ".join(base[::-1])]
    _, g, starts = neardup._sets(texts)
    low = (neardup.coordinates(g, starts) & np.uint32(3)).astype(np.uint8)
    packed = (low[::4] << 6 | low[1::4] << 4 | low[2::4] << 2 | low[3::4]).T
    bounds = np.append(starts, len(g))
    members = [{"rep": k, "sketch": np.ascontiguousarray(packed[k]).tobytes(), "grams": g[bounds[k] : bounds[k + 1]].tobytes()} for k in range(len(texts))]
    sets = [set(g[bounds[k] : bounds[k + 1]].tolist()) for k in range(len(texts))]
    expected = {(a, b) for a in range(20) for b in range(20, len(texts)) if len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b])}
    for held in (10**9, 1):
        monkeypatch.setattr(neardup, "BITS_HELD", held)
        found = {(int(x), int(y)) for u, v in neardup.similar_in_blocks(members[:20], members[20:], neardup.least_agreement(0.6), 0.6) for x, y in zip(u, v)}
        assert found == expected and len(found) > 20
