"""The operators over small dirty tables, empty tables, and tables with columns of clashing names."""

from __future__ import annotations

import re
from collections import defaultdict
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from callmill.llm import boilerplate, canonical, catalog, encoding, names, neardup, packing, sentences, splitting

NEEDS = {
    "p1_found": ["snapshots"], "p2_found": ["snapshots", "chunks"], "p3_found": ["target_list", "reference_list", "output_calls"], "p4_found": ["failures", "taxonomy"],
    "p6_found": ["failures", "output_calls"], "p7_ids": ["documents"], "p8_containers": ["documents"], "p9_found": ["documents"],
}
CLASH = {"_text": "x", "id": 9, "key": "k", "text": "y", "ids": "z", "value": "v", "core": "c", "n": 1, "class": 2, "firm": "f", "name": "n", "container_id": "q", "piece_no": 1, "features": "f", "prediction": 1.0, "line_no": 3, "char_start": 1}
LATER = datetime(2026, 5, 1)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("query", sorted(NEEDS))
def test_empty_tables(spark, tables, query):
    found = catalog.queries()[query](spark, tables(**{t: [] for t in NEEDS[query]}))
    assert found.count() == 0 and len(found.columns) >= 2


def test_splitting(spark, tables):
    long = "Aa bb. " * 900 + "\f" + "x" * 9000
    snapshots = [{"source_id": "s", "snapshot_text": long}, {"source_id": "s", "snapshot_text": long, "loaded_at": LATER}, {"source_id": "n", "snapshot_text": None}, {"source_id": None, "snapshot_text": long}]
    ids = ["p1-1", "p2-9", "p1-2", f"char:10-{len(long)}", "char:0-100", "odd", "p0-1", "char:9-2", None]
    chunks = [{"source_id": "s", "chunk_id": i} for i in ids] * 2 + [{"source_id": "n", "chunk_id": "p1-1"}, {"source_id": None, "chunk_id": "p1-1"}]
    found = splitting.p2_found(spark, tables(extra=CLASH, snapshots=snapshots, chunks=chunks))
    assert found.columns == ["source_id", "chunk_id", "piece_no", "char_start", "char_end"]
    pages = long.split("\f")
    texts = {"p1-1": pages[0], "p0-1": pages[0], "p2-9": pages[1], "p1-2": long, f"char:10-{len(long)}": long[10:]}
    assert rows_of(found) == sorted(("s", c, i, a, b) for c, t in texts.items() if len(t) > 4000 for i, (a, b) in enumerate(splitting.cut(t)))


def test_encoding_and_packing(spark, tables):
    texts = {1: None, 2: "", 3: " ", 4: "same text", 5: "same text", 6: "word " * 9000, 7: "x" * 45_000, 8: "<|endoftext|>"} | {100 + i: "tie tie" for i in range(50)}
    d = tables(extra=CLASH, documents=[{"doc_id": k, "text": t} for k, t in texts.items()])
    ids = {r.doc_id: list(r.ids) for r in encoding.p7_ids(spark, d).collect()}
    assert ids == {k: encoding.encode(t) for k, t in texts.items()} and ids[1] == ids[2] == []
    found = packing.p8_containers(spark, d).collect()
    used, by = defaultdict(int), defaultdict(list)
    for r in found:
        used[r.container_id] += r.token_end - r.token_start
        by[r.doc_id].append((r.token_start, r.token_end))
    assert set(by) == set(texts) and max(used.values()) <= packing.CAPACITY
    for k, parts in by.items():
        parts.sort()
        assert parts[0][0] == 0 and parts[-1][1] == len(ids[k]) and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
        assert len(parts) == 1 or len(ids[k]) > packing.CAPACITY
    assert len(used) <= -(-sum(map(len, ids.values())) // packing.CAPACITY) + 1


def test_packing_in_groups(spark):
    items = spark.createDataFrame([(i, (i * 37) % 100) for i in range(2000)] + [(5, 7), (5, 7)], "k bigint, n int")
    found = packing.pack(items, "k", "n", capacity=100, group=300).toPandas()
    assert len(found[found.token_end > 0]) + len(found[found.token_end == 0]) == 2002
    assert (found.assign(n=found.token_end - found.token_start).groupby("container_id").n.sum() <= 100).all()
    assert found.container_id.nunique() <= 1.06 * items.agg(F.sum("n")).first()[0] / 100 + 8


def test_packing_under_attention(spark):
    """Items that attention forbids are divided, others are not, and every limit holds."""
    rows = [(i, (i * 41) % 130) for i in range(500)] + [(900, 1000), (901, 0), (902, None)]
    items = spark.createDataFrame(rows, "k bigint, n int")
    found = packing.pack(items, "k", "n", capacity=100, most_documents=5, most_attention=1600, group=200).toPandas()
    found = found.assign(n=found.token_end - found.token_start)
    used = found.groupby("container_id").n.agg(["sum", "count", lambda x: (x**2).sum()])
    assert (used.iloc[:, 0] <= 100).all() and (used.iloc[:, 1] <= 5).all() and (used.iloc[:, 2] <= 1600).all()
    assert found.groupby("k").n.sum().to_dict() == {k: n or 0 for k, n in rows}
    assert all(count == max(1, -(-(n or 0) // 40)) for (k, n), count in zip(rows, found.groupby("k").n.count()[[k for k, _ in rows]]))


def test_canonical(spark, tables):
    taxonomy = spark.read.parquet("/root/testdata/sf0.001/taxonomy.parquet").toPandas().to_dict("records")
    leaf = {r["sub_asset_class"]: int(r["leaf_no"]) for r in taxonomy}
    wanted = {
        "Chile Lnkers": "Chile Linkers", "adding to Linkers, Chile (hedged)": "Chile Linkers", "SPANISH govvies": "Spain Government Debt", "Aktien in Singapore": "Singapore Listed Shares", " Gold Bullion": "Gold Bullion",
        "peso (Chile)": "Chilean Peso", "THB": "Thai Baht", "oil - tactical": "Crude Petroleum", "Bazilian Listed Shares": "Brazil Listed Shares", "Growth_Style": "Growth Style", "tulip futures": None, "Sanish Property": None, "x" * 60_000: None,
        "??": None, "rice": None, "Theme, Clean Water": None, "Water Theme, Clean": "Clean Water Theme",
    }
    failures = [{"failure_id": i, "sub_asset_raw": v, "sub_asset_class": "Gold Bullion"} for i, v in enumerate(wanted)] * 2
    failures += [{"failure_id": 900 + i, "sub_asset_raw": v, "sub_asset_class": v} for i, v in enumerate([None, "", " \t ", "\xa0", "Gold Bullion"])] + [{"failure_id": None, "sub_asset_raw": "oil"}, {"failure_id": 950, "sub_asset_class": "oil", "sub_asset_raw": "oil"}]
    d = tables(extra=CLASH, failures=failures, taxonomy=[{k: v for k, v in r.items()} for r in taxonomy])
    found = canonical.p4_found(spark, d)
    expected = [(i, "sub_asset_raw", leaf[w] if w else 0) for i, w in enumerate(wanted.values())] + [(950, f, leaf["Crude Petroleum"]) for f in ("sub_asset_class", "sub_asset_raw")]
    assert rows_of(found) == sorted(expected)


def test_canonical_against_brute_force(spark):
    """The segment join loses no partner that comparing all pairs finds."""
    d = "/root/testdata/sf0.001"
    taxonomy = spark.read.parquet(f"{d}/taxonomy.parquet").select("leaf_no", "sub_asset_class")
    failures = spark.read.parquet(f"{d}/failures.parquet")
    values = spark.sql(canonical.CASES, failures=failures, taxonomy=taxonomy).select("value").distinct()
    made = {r.value: r.leaf_no for r in canonical.canonicalise(values, taxonomy).collect()}
    words = canonical.Words.read()
    refs = canonical.references(taxonomy, words)
    cored = values.withColumn("core", F.expr(canonical.stripped(canonical.plain("value"), words)))
    near = cored.join(F.broadcast(refs), F.expr("core = ref OR length(core) >= 5 AND length(ref) >= 5 AND levenshtein(core, ref, 2) BETWEEN 1 AND 2")).collect()
    best = defaultdict(dict)
    for r in near:
        if r.core == r.ref:
            best[r.value].setdefault(0, set()).add(r.leaf_no)
        elif names.one_edit(r.core, r.ref):
            best[r.value].setdefault(1, set()).add(r.leaf_no)
    exact = {v: next(iter(x)) if len(x := best[v][min(best[v])]) == 1 else 0 for v in best if best[v]}
    assert {v: n for v, n in made.items() if n or v in exact} == exact


def test_canonical_of_another_list(spark):
    """Cities with aliases of the caller's own and no table of words; an entry without text and a null alias stand for nothing."""
    cities = spark.createDataFrame([(1, "München", "x"), (2, "New York", "x"), (3, "Saint Petersburg", "x"), (4, None, "x")], "leaf_no int, sub_asset_class string, ref string")
    aliases = spark.createDataFrame([(1, "Munich"), (2, "NYC"), (2, "Big Apple"), (3, None), (3, "St. Petersburg")], "leaf_no int, text string")
    wanted = {"munich": 1, "Münchn": 1, "Munihc": 1, "nyc": 2, "NYD": 0, "york, new": 2, "Big Aple": 2, "saint-petersburg": 3, "St Petersburg": 3, "Boston": 0, "visit Munich": 0}
    values = spark.createDataFrame([(v,) for v in wanted], "value string")
    assert {r.value: r.leaf_no for r in canonical.canonicalise(values, cities, aliases, canonical.Words()).collect()} == wanted
    wrapped = canonical.canonicalise(values, cities, aliases, canonical.Words(before=("visit",)))
    assert {r.value: r.leaf_no for r in wrapped.collect()} == wanted | {"visit Munich": 1}


def test_names(spark, tables):
    firm = ["Margaret Tornolmersil Private Bank", "MARGARET TORNOLMERSIL Pvt Bank LLC", "Tornolmersil, Margaret – Private Bank", "Peggy Tornolmersil PB", "M. Tornolmersil Private Bank", "Margaret Trnolmersil Priv. Bank", "Margaret T0rn01mersi1 Private Bank"]
    other = ["Margaret Tornolmonvak Private Bank", "Margaret Tornolmersil Fund Managers"]
    rows = [{"list_row": i, "firm": f} for i, f in enumerate([*firm, *other, None, "", "  ", "??"])]
    calls = [{"call_id": i, "firm": f} for i, f in enumerate(firm)] * 2
    refs = [{"ref_row": 1, "entity_name": "x" * 30_000}]
    clash = {k: v for k, v in CLASH.items() if k != "firm"}
    found = names.p3_found(spark, tables(extra=clash, target_list=rows, output_calls=calls, reference_list=refs))
    assert rows_of(found) == sorted((a, b) for a in firm for b in firm if a < b)


def test_names_in_common_blocks(spark, monkeypatch):
    """Refined and sliced blocks find the same links: edits, initials and the words they stand for, lengths at the ratio's edge, other businesses, none."""
    rng = __import__("random").Random(2)
    syllables = "gom har wil nol sed kel bux cor tal fen".split()
    made = ["".join(rng.choices(syllables, k=4)) for _ in range(40)]
    spelled = [f"{m.title()} Fund Managers" for m in made] + [f"{m[:3]}{m[4:]} Fund Managers" for m in made] + [f"{m} FM" for m in made] + made[:10] + [f"{m} Private Bank" for m in made[:10]]
    spelled += [f"{g} {m} Fund Managers" for m in made[:15] for g in ("C", "Christopher", "Bartholomew", "B.")] + [f"{made[0][:11]} Fund Managers", f"{made[0][:11]}abc Fund Managers", f"{made[3]} Van Christopher FM", f"Van C {made[3]} FM"]
    df = spark.createDataFrame([(x,) for x in set(spelled)], "name string")
    nodes = names._parsed(df, names.DEFAULT).select("core", "business").distinct()
    linked = lambda: sorted(tuple(r) for r in names._links(nodes).collect())
    plain, whole = linked(), sorted(tuple(r) for r in names.firms(df).collect())
    assert any(" " in a or " " in b for a, b in plain)
    for common, cut in ((1, 10**6), (1, 3), (20, 5)):
        monkeypatch.setattr(names, "COMMON", common)
        monkeypatch.setattr(names, "SLICE", cut)
        assert linked() == plain
    assert sorted(tuple(r) for r in names.firms(df).collect()) == whole


def test_names_many_cores_on_one_suffix(spark):
    """Ten thousand cores that end alike: those that are one edit apart are linked, all others aren't."""
    letters = "bdfghklmnprstvz"
    made = [f"{a}{b}{c}{d}enburgwald" for a in letters for b in letters for c in letters for d in "bdf"]
    assert len(set(made)) > 10_000
    nodes = spark.createDataFrame([(m, "private bank") for m in made], "core string, business string")
    pairs = names._candidates(nodes)
    assert pairs.where("substring(a, 1, 3) = substring(b, 1, 3)").count() >= len(made) // 3 * 3


def test_names_of_another_trade(spark):
    """Kinds that the names show themselves stand where the lexicon knows none."""
    made = ["Zelkorn", "Martuval", "Ostrenbek", "Quilvanor", "Pelstramo", "Drovenhal"]
    spelled = [f"{m} {kind}" for m in made for kind in ("Dental Clinic", "Bakery", "bakery.", "Freight Lines")] + ["Zelkon Dental Clinic", "Martuvl Freight Lines", "DROVENHAL FREIGHT LINES"]
    df = spark.createDataFrame([(x,) for x in set(spelled)], "name string")
    kinds = names.found_kinds(df, least=5)
    assert kinds == ["bakery", "dental clinic", "freight lines"]
    firm = {r.name: r.firm for r in names.firms(df, names.Lexicon(businesses={}).with_kinds(kinds)).collect()}
    assert firm["Zelkorn Dental Clinic"] == firm["Zelkon Dental Clinic"] != firm["Zelkorn Bakery"] == firm["Zelkorn bakery."]
    assert firm["Drovenhal Freight Lines"] == firm["DROVENHAL FREIGHT LINES"] and firm["Martuval Freight Lines"] == firm["Martuvl Freight Lines"]
    assert len(set(firm.values())) == 18


def test_names_of_any_length(spark):
    long = "ab" * 15_000
    df = spark.createDataFrame([(long,), (long[:-1],), ("x",)], "name string")
    firm = {r.name: r.firm for r in names.firms(df).collect()}
    assert firm[long] == firm[long[:-1]] != firm["x"]


def test_neardup(spark, tables):
    base = "the quick brown fox jumps over the lazy dog while seven red birds sing in tall green trees near old stone walls"
    texts = {1: base, 2: base.upper() + "!", 3: base.replace("seven", "eight"), 4: "entirely " * 20, 5: base[:40], 6: None, 7: "", 8: "other words stand here and have nothing at all to do with any of the rest of them today", 9: " ".join([f"w{i}" for i in range(30_000)])}
    failures = [{"failure_id": k, "evidence_quote": t} for k, t in texts.items()] * 2 + [{"failure_id": None, "evidence_quote": base}]
    calls = [{"call_id": k, "full_commentary": base} for k in (11, 12, 13)]
    found = neardup.p6_found(spark, tables(extra=CLASH, failures=failures, output_calls=calls))
    assert rows_of(found) == [("failures", 1, 2), ("failures", 1, 3), ("failures", 2, 3), ("output_calls", 11, 12), ("output_calls", 11, 13), ("output_calls", 12, 13)]


def test_neardup_against_brute_force(spark):
    d = "/root/testdata/sf0.001"
    found = set(rows_of(neardup.p6_found(spark, d)))
    words = re.compile(r"[^\W_]+")
    expected = set()
    for table, key, text in (("failures", "failure_id", "evidence_quote"), ("output_calls", "call_id", "full_commentary")):
        sets = {}
        for r in spark.read.parquet(f"{d}/{table}.parquet").select(key, text).collect():
            w = words.findall((r[1] or "").lower())
            if len(w) >= 12:
                sets[r[0]] = set(zip(w, w[1:], w[2:]))
        expected |= {(table, a, b) for a, x in sets.items() for b, y in sets.items() if a < b and len(x & y) >= 0.6 * len(x | y)}
    assert found == expected and expected


def test_neardup_common_keys(spark, monkeypatch):
    """Keys that many classes share go through slices, whatever a bucket may hold, with the same result."""
    common = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    rows = spark.createDataFrame([(i, f"{common} tail{i}") for i in range(60)], "k int, t string")
    plain = sorted(tuple(r) for r in neardup.near_duplicates(rows, "k", "t")[1].collect())
    assert len(plain) == 60 * 59 // 2
    for held in (1_000_000, 50):
        monkeypatch.setattr(neardup, "STRETCH", 7)
        monkeypatch.setattr(neardup, "HELD", held)
        assert sorted(tuple(r) for r in neardup.near_duplicates(rows, "k", "t")[1].collect()) == plain


def test_neardup_compact(spark, tables):
    """Classes and links give back all pairs."""
    d = "/root/testdata/sf0.001"
    rows = rows_of(neardup.p6_classes(spark, d))
    pairs = set()
    for table in ("failures", "output_calls"):
        of, links = {}, {(x, y) for t, kind, x, y in rows if t == table and kind == "link"}
        for t, kind, x, y in rows:
            if t == table and kind == "member":
                of[x] = y
        pairs |= {(table, a, b) for a in of for b in of if a < b and (of[a] == of[b] or (min(of[a], of[b]), max(of[a], of[b])) in links)}
    assert pairs == set(rows_of(neardup.p6_found(spark, d)))


def test_components(spark):
    from callmill.llm.common import components

    edges = spark.createDataFrame([(f"{i:03}", f"{i + 1:03}") for i in range(40)] + [("z1", "z2"), ("z2", "z2")], "a string, b string")
    nodes = spark.createDataFrame([(f"{i:03}",) for i in range(41)] + [("z1",), ("z2",), ("alone",)], "node string")
    assert dict(rows_of(components(edges, nodes))) == {f"{i:03}": "000" for i in range(41)} | {"z1": "z1", "z2": "z1", "alone": "alone"}


def test_boilerplate(spark, tables):
    """Pages held out from the table's own wording: known furniture around a plain article."""
    article = ["Why carry matters over the summer", "Yields rose 2.1% in Chile, although copper continue to fall on income and the outlook stays firm.", "", "We trimmed utilities by 40 basis points in Q3 2026, preferring copper for their income and momentum in the long run."]
    around = ["Home | Insights | Funds | Contact", "This site uses cookies and similar tools to measure visits.", "Accept all"], ["", "Most read", "Key questions for 2027 (3 min)", "© 2027 Abcdefick Fund Managers", "Back to top"]
    text = "\n".join([*around[0], *article, *around[1]])
    url = "https://x.example/views/why-carry-matters-over-the-summer?page=2"
    rows = [{"source_id": "a", "source_type": "html", "resolved_url": url, "snapshot_text": text}] * 2 + [{"source_id": "b", "source_type": "pdf", "snapshot_text": text}, {"source_id": "c", "source_type": "html", "snapshot_text": None}]
    rows += [{"source_id": "d", "source_type": "html", "snapshot_text": ""}, {"source_id": "e", "source_type": "html", "snapshot_text": "word " * 30_000}, {"source_id": None, "source_type": "html", "snapshot_text": text}, {"source_id": "f", "source_type": None, "snapshot_text": text}]
    found = rows_of(boilerplate.p1_found(spark, tables(extra=CLASH, snapshots=rows)))
    assert [n for s, n in found if s == "a"] == [0, 1, 2, *range(8, 12)] and not {s for s, _ in found} - {"a", "e"}


def test_boilerplate_held_out(spark):
    """Of the labelled pages, a third is kept from the tree and from the words' odds: at least 95 % of its lines must come out right."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.functions import array_to_vector

    pages = boilerplate.labelled()
    kept = tuple(n for n in range(len(pages)) if n % 3)
    rows = [(f, float(label[i]), n % 3) for n, (url, lines, label) in enumerate(pages) for i, f in boilerplate.features(url, lines, boilerplate.Corpus({}, boilerplate.word_odds(kept, n)))]
    table = spark.createDataFrame(rows, "f array<double>, label double, part int").withColumn("features", array_to_vector("f"))
    model = DecisionTreeClassifier(maxDepth=boilerplate.DEPTH, minInstancesPerNode=boilerplate.LEAST_ROWS, maxBins=64, seed=7).fit(table.where("part > 0"))
    right = model.transform(table.where("part = 0")).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert right >= 0.95


def test_sentences(spark, tables):
    texts = {1: None, 2: "", 3: " \n\t ", 4: "One. Two!\r\n\r\n- item. Still item", 5: "One. Two!\r\n\r\n- item. Still item", 6: "word " * 9000, 7: "x" * 45_000, 8: "Rates fell today. " * 2000}
    found = defaultdict(list)
    for k, a, b in rows_of(sentences.p9_found(spark, tables(extra=CLASH, documents=[{"doc_id": k, "text": t} for k, t in texts.items()]))):
        found[k].append(texts[k][a:b])
    assert set(found) == {4, 5, 6, 7, 8} and found[4] == found[5]
    assert found[4][-1] == "- item. Still item" and found[7] == ["x" * 45_000] and found[6] == [("word " * 9000).strip()]
    assert found[8] == ["Rates fell today."] * 2000


def test_sentence_model_counts_every_document(spark):
    """Of 3,200 documents no count is missing: the model over a table is that of all texts at hand, words of few documents among them."""
    texts = ["Mr. Abc agrees. Yields fell. We trimmed utilities in Q3 2026.Not yet!", "Gold rose 4.1%. Copper fell! “Will it last?” asked one. Bonds held."] * 1_597 + [f"Zubrowo et al. bought zinc. Nickel fell.{' Tin rose.' * k}" for k in range(6)]
    assert len(texts) == 3_200
    rows = spark.createDataFrame(list(enumerate(texts)), "id bigint, _text string")
    made, wanted = sentences.fit_all(sentences.lay_out(rows)), sentences.fit(texts)
    assert "Zubrowo" in made.vocabulary and made.vocabulary == wanted.vocabulary
    assert made.follow == wanted.follow and made.total == wanted.total and made.kinds == wanted.kinds and made.words == wanted.words
    assert made.follow[(), "Zubrowo"] == 6 and made.follow[(), "Gold"] == 1_597


def test_sentence_model_is_bounded_by_full_counts(spark, monkeypatch):
    texts = ["Gold rose. Copper fell. Bonds held."] * 20 + ["Tin rose. Zinc fell."] * 8
    monkeypatch.setattr(sentences, "MOST_GRAMS", 12)
    made = sentences.fit_all(sentences.lay_out(spark.createDataFrame(list(enumerate(texts)), "id bigint, _text string")))
    assert 0 < sum(len(h) > 0 for h, _ in made.follow) <= 12 and all(n >= 20 for (h, _), n in made.follow.items() if h)


def test_boilerplate_counts_small_hosts_at_any_size(spark):
    """A part on three of 4,000 pages, all of one host, is a link there, as it is among few pages; a part of one page is none."""
    pages = [(f"s{i}", f"https://h{i}.example/a", f"Own line {chr(97 + i % 26)}{i}x\nUnlike words {'abcdefghij'[i % 10] * (i // 10 + 1)} here") for i in range(3_997)]
    pages += [(f"t{i}", "https://small.example/a", f"Small host partners\nOnly {'xyz'[i]} says this") for i in range(3)]
    rows = spark.createDataFrame(pages, "source_id string, resolved_url string, snapshot_text string")
    counts, total = boilerplate.counted(rows)
    assert total >= 4_000
    for r in counts.where("source_id like 't%'").collect():
        corpus = boilerplate.of_page({}, total, r.of_host, r["keys"], r.alls, r.hosts)
        place = boilerplate.NAMES.index("link")
        lines = dict(boilerplate.features("https://small.example/a", ["Small host partners", f"Only {'xyz'[int(r.source_id[1])]} says this"], corpus))
        assert lines[0][place] == 1.0 and lines[1][place] == 0.0 and lines[0][boilerplate.NAMES.index("host")] == 1.0
