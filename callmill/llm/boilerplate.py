"""Main content of pages without what their hosts put around it (problem 1).

A page's text is taken as flat lines. Each line is described by its words and its link density, by those of its
neighbours, and by where it stands, and a decision tree trained on a small labelled table (labelled_pages.txt) decides
whether it belongs to the article. Plain text has no links, so a line's link density is the share of its parts that
stand alone, as a link does, on other pages: on two of its host, or on LINK of all. These are numbers of pages, so a
small host's furniture counts alike in a corpus of any size. They are counted by host and over all pages, stay a table,
and are joined to the pages that have the parts. Pages of a host with the same lines count once.

Defined results: null and empty texts have no lines; blank lines are counted and never named; repeated rows of a
source count once; a page without address has no title line and is judged by the rest. Empty tables give no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import lru_cache
from pathlib import Path
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callmill.common import read, stored
from callmill.llm.common import map_texts

TABLE = Path(__file__).with_name("labelled_pages.txt")
#: Pages, of a host or of all, from which a part counts as a link, and the tree's size.
HOST_LINK, LINK, DEPTH, LEAST_ROWS = 2, 3, 9, 4
#: Words from which a line with an end mark counts as a paragraph.
PARAGRAPH = 12

_BULLET = re.compile(r"^\s*(?:[•*·–-]\s+|\d{1,2}[.)]\s+)")
_PARTS = re.compile(r"\s+[|·/»>›]\s+|\s{2,}|\t")
_END = re.compile(r"[.!?。！？…][\"”’»)」』]*$")
_WIDE = re.compile(r"[฀-໿぀-ヿ㐀-鿿가-힯]")
_DIGITS = re.compile(r"\d+")
_NOTE = re.compile(r"^([^:.]{2,40}): ")
_WORDS = re.compile(r"[^\W\d_]+|©")
_WIDE_PAIRS = re.compile(rf"(?=({_WIDE.pattern}{_WIDE.pattern}))")


def fold(part: str) -> str:
    return _DIGITS.sub("0", _BULLET.sub("", part).strip().lower())


def parts(line: str) -> list[str]:
    return [x for x in _PARTS.split(_BULLET.sub("", line).strip()) if x]


def part_key(part: str) -> int:
    return xxhash.xxh3_64_intdigest(fold(part)) >> 1


def host_of(url: str | None) -> str:
    """The address's host, empty without one."""
    found = re.match(r"\w+://([^/?#]*)", url or "")
    return found[1].lower() if found else ""


def page_keys(lines: list[str]) -> tuple[int, list[int], list[int]]:
    """(number of the page's content, keys it counts for, keys its features ask for)."""
    own = sorted({k for x in lines if x.strip() for k in keys(x)})
    asked = sorted({*own, *(part_key(p) for x in lines if x.strip() for p in parts(x))})
    return xxhash.xxh3_64_intdigest(",".join(map(str, own))) >> 1, own, asked


def keys(line: str) -> list[int]:
    """What is counted of a line: itself, and what stands before a colon."""
    note = _NOTE.match(line.strip())
    return [part_key(line), *([xxhash.xxh3_64_intdigest(fold(note[1]) + ":") >> 1] if note else [])]


def n_words(line: str) -> float:
    """Words; of scripts without spaces, half their characters."""
    if line.isascii():
        return float(len(line.split()))
    wide = len(_WIDE.findall(line))
    return len(_WIDE.sub(" ", line).split()) + wide / 2


def slug(text: str) -> str:
    return re.sub(r"[\W_]+", "-", text.lower()).strip("-")


class Corpus:
    """What a page's features need: the pages that have each of its parts (of all, of its host), and the words' log-odds."""

    def __init__(self, counts: dict[int, tuple[int, int]], odds: dict[str, float], total: int = 1, of_host: int = 1):
        self.counts, self.odds, self.total, self.of_host = counts, odds, total, of_host

    def share(self, key: int) -> float:
        """Share of all pages, 0 for a part of one page only."""
        n = self.counts.get(key, (0, 0))[0]
        return n / self.total if n > 1 else 0.0

    def on_host(self, key: int) -> float:
        """Share of the host's other pages."""
        n = self.counts.get(key, (0, 0))[1]
        return (n - 1) / (self.of_host - 1) if n > 1 and self.of_host > 1 else 0.0

    def link(self, key: int) -> bool:
        n, own = self.counts.get(key, (0, 0))
        return own >= HOST_LINK or n >= LINK


def words(line: str, above: str = "") -> list[str]:
    """The words and word pairs of a line, what stands before its colon, and the line above where that is short."""
    if line.isascii():
        one = _WORDS.findall(line.lower())
    else:
        one = _WORDS.findall(_WIDE.sub(" ", line).lower()) + _WIDE_PAIRS.findall(line)
    note = _NOTE.match(line.strip())
    return [*one, *map(" ".join, zip(one, one[1:])), *([fold(note[1]) + ":"] if note else []), *([f"under {fold(above)}"] if above and len(above) < 60 else [])]


NAMES = (
    "words chars marked share host link parts title since_title before_title note_share odds most_odds least_odds sum_odds note_odds bullet table digits capitals "
    "words_1 words_2 words1 words2 link_1 link_2 link1 link2 share_1 share1 marked_1 marked1 odds_1 odds1 blank_before blank_after "
    "index left paragraphs_before paragraphs_after run_length run_place run_share run_link run_odds run_special part_of_title"
).split()


#: What is told of the lines around: at two steps' distance their words and links only. A line that isn't there has none.
_NEAR = [(d, [(x, f"{x}_{-d}" if d < 0 else f"{x}{d}") for x in ("words", "link") + (("share", "marked", "odds") if abs(d) == 1 else ())]) for d in (-2, -1, 1, 2)]
_NOTHING = {"words": -1.0, "link": 0.0, "share": 0.0, "marked": -1.0, "odds": 0.0}


def features(url: str | None, lines: list[str], corpus: Corpus) -> list[tuple[int, list[float]]]:
    """(line number, features) of each line that is not blank."""
    at = [i for i, x in enumerate(lines) if x.strip()]
    # the longest part of the address after its host is the title's slug
    path = re.sub(r"^\w+://[^/]*/?", "", unquote(url or ""))
    address = slug(re.sub(r"\.html?$", "", max(re.split(r"[/=&?#]", path), key=len)))
    rows = []
    for i in at:
        line = lines[i].strip()
        ks, ps = keys(line), parts(line)
        link = sum(corpus.link(part_key(p)) for p in ps) / len(ps) if ps else 0.0
        above = lines[i - 1].strip() if i else ""
        known = [(w, odds) for w in words(line, above) if (odds := corpus.odds.get(w)) is not None]
        odd = [x for _, x in known]
        special = [x for w, x in known if w[-1] == ":" or w[:6] == "under "]
        name, split = slug(line), line.split()
        rows.append(
            {
                "words": n_words(line), "chars": len(line), "marked": float(bool(_END.search(line))), "share": math.log10(corpus.share(ks[0]) + 1e-4), "host": corpus.on_host(ks[0]), "link": link, "parts": len(ps),
                "slug": name, "title": float(bool(name) and name == address), "note_share": math.log10(corpus.share(ks[1]) + 1e-4) if len(ks) > 1 else -5.0, "odds": sum(odd) / len(odd) if odd else 0.0, "most_odds": max(odd, default=0.0), "least_odds": min(odd, default=0.0), "sum_odds": sum(odd), "note_odds": max(special, key=abs, default=0.0),
                "bullet": float(bool(_BULLET.match(line))), "table": float(len(ps) > 1 and any(map(str.isdigit, line))), "digits": sum(map(str.isdigit, line)) / len(line),
                "capitals": sum(w[0].isupper() for w in split) / max(1, len(split)), "blank_before": float(i == 0 or not lines[i - 1].strip()), "blank_after": float(i + 1 >= len(lines) or not lines[i + 1].strip()),
            }
        )
    title = next((n for n, r in enumerate(rows) if r["title"]), None)
    named = slug(lines[at[title]]) if title is not None else ""
    body = [r["words"] >= PARAGRAPH and r["marked"] > 0 and r["odds"] < 0 for r in rows]
    total, seen, run = sum(body), 0, 0
    out = []
    for n, (i, r) in enumerate(zip(at, rows)):
        short = r["words"] < PARAGRAPH and not r["marked"]
        run = run + 1 if short and n and rows[n - 1]["words"] < PARAGRAPH and not rows[n - 1]["marked"] else int(short)
        r["run_place"] = run
        above = rows[n - run + 1 : n + 1] if run else []
        # the line of the run above this one that the corpus repeats most is what may head a list of links
        head = max(range(len(above)), key=lambda k: above[k]["share"], default=None)
        r |= {"run_share": above[head]["share"] if above else -5.0, "run_link": sum(a["link"] for a in above) / len(above) if above else 0.0, "run_odds": max((a["odds"] for a in above), default=0.0), "run_special": max((a["note_odds"] for a in above), default=0.0)}
        length = n
        while length < len(rows) and rows[length]["words"] < PARAGRAPH and not rows[length]["marked"]:
            length += 1
        r |= {"run_length": run + max(0, length - n - 1) if run else 0, "index": n, "left": len(rows) - n - 1, "paragraphs_before": seen, "paragraphs_after": total - seen - body[n]}
        r |= {"since_title": n - title if title is not None else 0, "before_title": float(title is not None and n < title), "part_of_title": float(bool(named) and named in r["slug"])}
        seen += body[n]
        for d, wanted in _NEAR:
            near = rows[n + d] if 0 <= n + d < len(rows) else _NOTHING
            for x, as_name in wanted:
                r[as_name] = near[x]
        out.append((i, [float(r[x]) for x in NAMES]))
    return out


@lru_cache
def labelled() -> list[tuple[str, list[str], dict[int, int]]]:
    """(address, lines, label by line number) of the labelled pages; label 1 is boilerplate."""
    pages: list = []
    for row in TABLE.read_text(encoding="utf-8").split("\n")[1:]:
        if row[:1] == "@":
            pages.append((row[1:], [], {}))
        elif row:
            pages[-1][1].append(row[1:])
            if row[0] != "=":
                pages[-1][2][len(pages[-1][1]) - 1] = int(row[0] == "-")
    return pages


@lru_cache
def labelled_words() -> list[tuple[Counter, Counter]]:
    """(of the article, of the rest): in how many lines of each labelled page its words stand."""
    out = []
    for _, lines, label in labelled():
        by: tuple[Counter, Counter] = Counter(), Counter()
        for i, y in label.items():
            by[y].update(set(words(lines[i], lines[i - 1].strip() if i else "")))
        out.append(by)
    return out


@lru_cache
def _word_sums(kept: tuple[int, ...]) -> tuple[Counter, Counter, Counter]:
    lines: tuple[Counter, Counter] = Counter(), Counter()
    pages: Counter = Counter()
    for n in kept:
        for y in (0, 1):
            lines[y].update(labelled_words()[n][y])
        pages.update(labelled_words()[n][0].keys() | labelled_words()[n][1].keys())
    return *lines, pages


def word_odds(kept: tuple[int, ...] | None = None, of: int | None = None) -> dict[str, float]:
    """Log-odds for boilerplate of each word that two of the kept labelled pages (all) have.

    of: a page that is described by the words of the other pages alone, as unknown pages are; then only its own words are given.
    """
    kept = tuple(range(len(labelled()))) if kept is None else kept
    a, b, pages = _word_sums(kept)
    none: Counter = Counter()
    own_a, own_b = labelled_words()[of] if of in kept else (none, none)
    asked = pages if of is None else labelled_words()[of][0].keys() | labelled_words()[of][1].keys()
    n0, n1 = a.total() - own_a.total(), b.total() - own_b.total()
    other = 1 if of in kept else 0
    odds = lambda w: math.log((b[w] - own_b[w] + 0.5) / (n1 + 1)) - math.log((a[w] - own_a[w] + 0.5) / (n0 + 1))
    return {w: odds(w) for w in asked if pages[w] - other > 1}


def counted(pages: DataFrame) -> tuple[DataFrame, int]:
    """(source_id, label, of_host, keys, alls, hosts; number of pages): for each page, and each labelled page by its number,
    the pages of its host, and of each part that more than one page has the pages of all and of its host.
    """
    spark = pages.sparkSession
    kinds = "source_id string, label int, host string, page bigint, own array<bigint>, asked array<bigint>"
    ints = pa.list_(pa.int64())
    schema = pa.schema([("source_id", pa.string()), ("label", pa.int32()), ("host", pa.string()), ("page", pa.int64()), ("own", ints), ("asked", ints)])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(s, None, host_of(u), *page_keys(t.split("\n"))) for s, u, t in zip(*(batch.column(c).to_pylist() for c in ("source_id", "resolved_url", "snapshot_text")))]
        return pa.record_batch([pa.array([r[k] for r in rows], x.type) for k, x in enumerate(schema)], schema=schema)

    known = spark.createDataFrame([(None, n, host_of(url), *page_keys(lines)) for n, (url, lines, _) in enumerate(labelled())], kinds)
    found = stored(map_texts(pages.select("source_id", "resolved_url", "snapshot_text"), "snapshot_text", kinds, run).union(known), "page_keys")
    different = found.select("host", "page", "own").dropDuplicates(["host", "page"])
    of_host = stored(different.groupBy("host").agg(F.count("*").alias("of_host")), "host_pages")
    by_host = stored(different.select("host", F.explode("own").alias("key")).groupBy("host", "key").agg(F.count("*").alias("h")), "host_parts")
    by_all = by_host.groupBy("key").agg(F.sum("h").alias("n")).where("n > 1")
    asked = found.select("source_id", "label", "host", F.explode("asked").alias("key")).join(by_all, "key").join(by_host, ["host", "key"], "left")
    lists = asked.groupBy(F.col("source_id").alias("_source"), F.col("label").alias("_label")).agg(F.collect_list(F.struct("key", "n", F.coalesce("h", F.lit(0)).alias("h"))).alias("x"))
    match = F.col("source_id").eqNullSafe(F.col("_source")) & F.col("label").eqNullSafe(F.col("_label"))
    out = found.select("source_id", "label", "host").join(lists, match, "left").select("source_id", "label", "host", F.col("x.key").alias("keys"), F.col("x.n").alias("alls"), F.col("x.h").alias("hosts"))
    total = of_host.agg(F.coalesce(F.sum("of_host"), F.lit(0))).first()[0]
    return stored(out.join(of_host, "host").drop("host"), "page_counts"), total


def of_page(odds: dict[str, float], total: int, of_host: int, ks: list | None, alls: list | None, hosts: list | None) -> Corpus:
    return Corpus({k: (n, h) for k, n, h in zip(ks or (), alls or (), hosts or ())}, odds, total, of_host)


def train(spark: SparkSession, corpora: dict[int, Corpus]) -> DecisionTreeClassificationModel:
    """The tree of the labelled pages, each described by its own counts and by the other pages' words."""
    rows = [(f, float(label[i])) for n, (url, lines, label) in enumerate(labelled()) for i, f in features(url, lines, corpora[n])]
    table = spark.createDataFrame(rows, "f array<double>, label double").select(array_to_vector("f").alias("features"), "label").coalesce(1)
    return DecisionTreeClassifier(maxDepth=DEPTH, minInstancesPerNode=LEAST_ROWS, maxBins=64, seed=7).fit(table)


def boilerplate_lines(pages: DataFrame) -> DataFrame:
    """pages(source_id, resolved_url, snapshot_text), one row for each source -> source_id, line_no of what is not article."""
    odds, (counts, total) = word_odds(), counted(pages)
    columns = ("of_host", "keys", "alls", "hosts")
    model = train(pages.sparkSession, {r.label: of_page(word_odds(of=r.label), total, *(r[c] for c in columns)) for r in counts.where("label is not null").collect()})
    schema = pa.schema([("source_id", pa.string()), ("line_no", pa.int32()), ("f", pa.list_(pa.float64()))])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        given = zip(*(batch.column(c).to_pylist() for c in ("source_id", "resolved_url", "snapshot_text", *columns)))
        rows = [(s, i, f) for s, u, t, *c in given for i, f in features(u, t.split("\n"), of_page(odds, total, *c))]
        flat = pa.array(np.array([f for _, _, f in rows], np.float64).ravel())
        described = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(rows) + 1) * len(NAMES), len(NAMES)), pa.int32()), flat)
        return pa.record_batch([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()), described], schema=schema)

    own = pages.select("source_id", "resolved_url", "snapshot_text").join(counts.where("label is null").drop("label"), "source_id")
    described = map_texts(own, "snapshot_text", "source_id string, line_no int, f array<double>", run)
    return model.transform(described.withColumn("features", array_to_vector("f"))).where("prediction = 1").select("source_id", "line_no")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of html sources to be removed."""
    pages = read(spark, sf_dir, "snapshots").where("source_type = 'html' and source_id is not null and snapshot_text is not null")
    return boilerplate_lines(pages.select("source_id", "resolved_url", "snapshot_text").dropDuplicates(["source_id"]))
