"""Variant spellings of names typed by people (problem 3).

A name is taken apart into a kind of business and a distinctive core; legal forms, "Group" and "The" fall away, accents,
case and misread digits are folded, given names stand for their nicknames. Cores are compared in pairs that share a
block: the suffixes of a core's tokens and of its letters in a row, read from either end, from half its length on.
Only cores that some kind of business could share are compared; a core without business may share any. Suffixes that
many cores have are not dropped but refined with the kind of business and with the length, by what the comparison itself
demands of lengths (and of an initial and the word it stands for), so that no pair is lost; what is still common then
is cut into slices, and slices are paired in separate tasks. A pair is linked if the longest common subsequence covers
enough of both. Connected cores with one kind of business are one firm; a name without business belongs to the kind of
which the core has the most spellings.

The words for kinds of business, legal forms and nicknames are a Lexicon, which the caller may replace or extend by the
kinds that the names themselves show (found_kinds).

Work is done once for each different string. Defined results: null and blank names are no names; names that differ only
in white space or case are variants of each other; repeated rows count once; a firm with one spelling gives no pair.
Empty tables give none.
"""

from __future__ import annotations

import math
import re
import unicodedata
from dataclasses import dataclass, field, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callmill.common import read, stored
from callmill.llm.common import components, map_texts

#: Least ratio of twice the longest common subsequence to both lengths.
LEAST_RATIO = 0.88
#: Shortest suffix that is indexed, how many cores may share one before it is refined, and cores of a refined key that one task pairs.
LEAST_SUFFIX, COMMON, SLICE = 5, 200, 2_000
#: Letters up to which every suffix is indexed; of longer ones those of which each is a twentieth longer than the one before.
EVERY_SUFFIX = 40
#: Kinds of business that a lexicon may have; more are refused.
MOST_KINDS = 10_000

# Kinds of business and how they are written. Forms of up to four letters must stand alone.
BUSINESSES = {
    "asset management": "asset management, asset mgmt, asset mgt, asset manag, am",
    "fund managers": "fund managers, fund mgrs, fund mngrs, fd managers, fm",
    "global investors": "global investors, glob investors, glbl investors, global inv, gi",
    "investments": "investments, invmts, investmts, invest, inv",
    "investment counsel": "investment counsel, inv counsel, invst counsel, ic",
    "wealth advisors": "wealth advisors, wealth adv, wealth advs, wlth advisors, wa",
    "capital partners": "capital partners, cap partners, cap ptrs, capital ptnrs, cp",
    "research institute": "research institute, research inst, rsch institute, ri",
    "private bank": "private bank, priv bank, pvt bank, pb",
    "life and pensions": "life and pensions, life and pens, l and p",
}

# Legal forms and other words that name no firm.
IDLE = "llc inc incorporated ltd limited plc ag gmbh sa nv llp lp corp corporation co company bv spa se ab oy group the".split()

# Given names and their short forms.
NICKNAMES = {
    "michael": "mike mick mikey", "richard": "dick rick rich ricky", "theodore": "theo ted teddy", "edward": "ed eddie ted ned", "william": "bill will billy willy",
    "margaret": "peggy maggie meg marge", "elizabeth": "liz beth betty eliza lizzie", "charles": "chuck charlie chas", "robert": "bob rob bobby bert",
    "katherine": "kate kathy katie", "catherine": "cathy cate kate", "james": "jim jimmy jamie", "john": "jack johnny", "thomas": "tom tommy", "joseph": "joe joey",
    "anthony": "tony", "daniel": "dan danny", "matthew": "matt", "patricia": "pat patty trish", "jennifer": "jen jenny", "susan": "sue susie", "barbara": "barb babs",
    "alexander": "alex sandy", "andrew": "andy drew", "benjamin": "ben", "christopher": "chris", "david": "dave", "gregory": "greg", "henry": "harry hank", "lawrence": "larry",
    "nicholas": "nick", "peter": "pete", "philip": "phil", "ronald": "ron", "samuel": "sam", "stephen": "steve", "timothy": "tim", "victoria": "vicky", "walter": "walt",
    "frederick": "fred freddie", "francis": "frank", "deborah": "debbie deb", "judith": "judy", "pamela": "pam", "rebecca": "becky", "abigail": "abby",
}

@dataclass(frozen=True)
class Lexicon:
    """What names are taken apart by: forms of each kind of business, words that name no firm, short forms of given names."""

    businesses: dict[str, str] = field(default_factory=lambda: BUSINESSES)
    idle: tuple[str, ...] = tuple(IDLE)
    nicknames: dict[str, str] = field(default_factory=lambda: NICKNAMES)

    def __post_init__(self):
        forms = ((tuple(f.split()), b) for b, fs in self.businesses.items() for f in (x.strip() for x in fs.split(",")))
        object.__setattr__(self, "forms", sorted(forms, key=lambda x: -len("".join(x[0]))))
        object.__setattr__(self, "long", [("".join(form), business) for form, business in self.forms if len("".join(form)) >= 7])
        formal: dict[str, list[str]] = {}
        for name, short in self.nicknames.items():
            for s in short.split():
                formal.setdefault(s, []).append(name)
        object.__setattr__(self, "formal", formal)

    def with_kinds(self, kinds: list[str]) -> Lexicon:
        """The same with kinds of business that are written out only."""
        return replace(self, businesses=self.businesses | {k: k for k in kinds if k not in self.businesses})


DEFAULT = Lexicon()


def one_edit(a: str, b: str) -> bool:
    """At most one insertion, deletion, substitution or swap of neighbours apart."""
    if a == b:
        return True
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    if len(a) < len(b):
        return a[i:] == b[i + 1 :]
    return a[i + 1 :] == b[i + 1 :] or a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :]


def tokens(raw: str, lexicon: Lexicon = DEFAULT) -> list[str]:
    """Folded words: no accents, dots of initials joined, misread digits as letters, no legal forms at the ends."""
    text = "".join(c for c in unicodedata.normalize("NFKD", raw) if not unicodedata.combining(c)).casefold()
    text = re.sub(r"(?<![^\W\d_])((?:[a-z]\.){2,})", lambda m: m[0].replace(".", "") + " ", text)
    words = re.findall(r"[^\W_]+", text.replace("&", " and "))
    words = [w.translate(str.maketrans("015", "ols")) if re.search("[^0-9]", w) else w for w in words]
    while words and words[-1] in lexicon.idle and len(words) > 1:
        words.pop()
    while len(words) > 1 and words[0] == "the":
        words.pop(0)
    return words


def take_apart(raw: str, lexicon: Lexicon = DEFAULT) -> tuple[str | None, list[str]]:
    """Kind of business, or None, and the words of the core in their order."""
    words = tokens(raw, lexicon)
    for form, business in lexicon.forms:
        n = len(form)
        if len(words) > n:
            if tuple(words[-n:]) == form:
                return business, words[:-n]
            if tuple(words[:n]) == form:
                return business, words[n:]
    joined = "".join(words)
    long = lexicon.long
    for form, business in long:
        if len(words[-1]) > len(form) + 2 and words[-1].endswith(form):
            return business, [*words[:-1], words[-1][: -len(form)]]
    for form, business in long:
        for n in (1, 2, 3, 4):
            if len(words) > n:
                if one_edit("".join(words[-n:]), form):
                    return business, words[:-n]
                if one_edit("".join(words[:n]), form):
                    return business, words[n:]
    for form, business in long:
        if len(words) <= 2:
            for n in (len(form), len(form) + 1, len(form) - 1):
                if len(joined) > n + 4 and one_edit(joined[-n:], form):
                    return business, [joined[:-n]]
    return None, words


def cores(words: list[str], lexicon: Lexicon = DEFAULT) -> list[list[str]]:
    """The core's words without "and", with a nickname as each formal name that it may stand for."""
    words = [w for w in words if w != "and"] or words
    for i, w in enumerate(words):
        if w in lexicon.formal and len(words) > 1:
            return [[*words[:i], formal, *words[i + 1 :]] for formal in lexicon.formal[w]]
    return [words]


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row at a time in the bits of an integer."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = row = (1 << len(a)) - 1
    for c in b:
        hit = row & places.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    return 2 * common_subsequence(a, b) / ((len(a) + len(b)) or 1)


def same_core(a: str, b: str) -> bool:
    """Two cores, words separated by spaces: as they stand, with their words sorted, or with a given name's initial."""
    x, y = a.split(), b.split()
    if ratio("".join(x), "".join(y)) >= LEAST_RATIO or ratio("".join(sorted(x)), "".join(sorted(y))) >= LEAST_RATIO:
        return True
    for p, q in ((x, y), (y, x)):
        short = [w for w in p if len(w) == 1]
        if len(short) == 1 and len(p) > 1:
            whole = next((w for w in q if len(w) > 1 and w[0] == short[0] and len(q) > 1), None)
            if whole and ratio("".join(w for w in p if len(w) > 1), "".join(w for w in q if w != whole)) >= LEAST_RATIO:
                return True
    return False


def _parsed(names: DataFrame, lexicon: Lexicon) -> DataFrame:
    schema = pa.schema([("name", pa.string()), ("business", pa.string()), ("core", pa.string())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for name in batch.column("name").to_pylist():
            business, words = take_apart(name, lexicon)
            rows += [(name, business, " ".join(c)) for c in cores(words, lexicon)]
        return pa.record_batch([pa.array(x, pa.string()) for x in (zip(*rows) if rows else ((), (), ()))], schema=schema)

    return map_texts(names, "name", "name string, business string, core string", run)


def _blocks(nodes: DataFrame) -> DataFrame:
    """core, business, key: hashes of the suffixes of tokens and of all letters, from either end.

    Long strings are indexed at some lengths only; they begin a twentieth earlier, so that every pair that shares a
    suffix of half its length shares one of these.
    """
    letters = F.regexp_replace("core", " ", "")
    strings = F.array_distinct(F.concat(F.array(letters), F.filter(F.split("core", " "), lambda w: F.length(w) >= LEAST_SUFFIX)))
    ends = F.flatten(F.transform(strings, lambda w: F.array(F.struct(F.lit("s").alias("end"), w.alias("w")), F.struct(F.lit("p").alias("end"), F.reverse(w).alias("w")))))
    each = nodes.select("core", "business", F.explode(ends).alias("e")).select("core", "business", "e.*").withColumn("n", F.length("w"))
    steps = [EVERY_SUFFIX]
    while steps[-1] < 100_000:
        steps.append(max(steps[-1] + 1, int(steps[-1] * 1.05)))
    half = F.floor(F.col("n") / 2) - 1
    least = F.greatest(F.lit(LEAST_SUFFIX), F.when(half > EVERY_SUFFIX, F.floor(half * 0.95)).otherwise(half)).cast("int")
    short = F.when(least <= F.least(F.col("n"), F.lit(EVERY_SUFFIX)), F.sequence(least, F.least(F.col("n"), F.lit(EVERY_SUFFIX)))).otherwise(F.array().cast("array<int>"))
    far = F.when(F.col("n") > EVERY_SUFFIX, F.filter(F.array(*[F.lit(x) for x in steps[1:]]), lambda x: (x >= least) & (x <= F.col("n")))).otherwise(F.array().cast("array<int>"))
    sized = each.withColumn("k", F.explode(F.when(F.col("n") >= LEAST_SUFFIX, F.array_distinct(F.concat(short, far, F.array(F.col("n"))))).otherwise(F.array(F.col("n")))))
    return sized.select("core", "business", F.xxhash64("end", F.expr("right(w, k)")).alias("key")).distinct()


def _steps(n: Column) -> Column:
    """The step of a length and the next one: two lengths of which the ratio allows both share one."""
    # a step is a little wider than the ratio, so that lengths at its very edge are one step apart at most
    step = F.floor(F.log(F.greatest(n, F.lit(1))) / (1.0001 * math.log((2 - LEAST_RATIO) / LEAST_RATIO)))
    return F.array(step.cast("string"), (step + 1).cast("string"))


def _refined(blocks: DataFrame, kinds: list[str]) -> DataFrame:
    """core, key of what shares a common key: with the kind of business, and with the length that same_core demands.

    That is the length of all letters, or, of an initial and a word that it may stand for, of the letters besides.
    """
    words = F.split("core", " ")
    every = F.array(*[F.lit(k) for k in kinds or [""]])
    known = blocks.withColumn("_kind", F.explode(F.when(F.col("business").isNull(), every).otherwise(F.array("business"))))
    n = F.length(F.regexp_replace("core", " ", ""))
    whole = F.transform(_steps(n), lambda s: F.concat_ws("|", F.lit("n"), s))
    initials = F.filter(words, lambda w: F.length(w) == 1)
    many = F.size(words) > 1
    short = F.when(many & (F.size(initials) == 1), F.transform(_steps(n - 1), lambda s: F.concat_ws("|", F.lit("i"), F.get(initials, 0), s)))
    stood = F.flatten(F.transform(F.filter(words, lambda w: F.length(w) > 1), lambda w: F.transform(_steps(n - F.length(w)), lambda s: F.concat_ws("|", F.lit("i"), F.substring(w, 1, 1), s))))
    none = F.array().cast("array<string>")
    marks = F.array_distinct(F.concat(whole, F.coalesce(short, none), F.when(many, stood).otherwise(none)))
    return known.select("core", "key", "_kind", F.explode(marks).alias("_mark")).select("core", F.xxhash64("key", "_kind", "_mark").alias("key")).distinct()


def _candidates(nodes: DataFrame) -> DataFrame:
    """The different pairs of cores that share a suffix and may share a kind of business."""
    blocks = stored(_blocks(nodes), "blocks")
    kinds = [r.business for r in nodes.where("business is not null").select("business").distinct().take(MOST_KINDS + 1)]
    if len(kinds) > MOST_KINDS:
        raise ValueError("kinds of business are few by contract")
    common = blocks.groupBy("key").count().where(F.col("count") > COMMON).select("key")
    plain = blocks.join(common, "key", "left_anti")
    left, right = plain.select(F.col("core").alias("a"), F.col("business").alias("x"), "key"), plain.select(F.col("core").alias("b"), F.col("business").alias("y"), "key")
    pairs = left.join(right, "key").where("a < b and (x is null or y is null or x = y)").select("a", "b")
    fine = stored(_refined(blocks.join(common, "key", "left_semi"), kinds), "refined")
    slices = fine.groupBy("key").agg(F.ceil(F.count("*") / SLICE).cast("int").alias("slices")).where("slices > 1")
    cut = fine.join(slices, "key", "left").withColumn("slices", F.coalesce("slices", F.lit(1))).withColumn("own", F.pmod(F.xxhash64("core"), F.col("slices")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("slices") - 1))
    first = cut.select(F.col("core").alias("a"), "key", F.col("own").alias("i"), other.alias("j"))
    second = cut.select(F.col("core").alias("b"), "key", F.col("own").alias("j"), other.alias("i"))
    return pairs.unionByName(first.join(second, ["key", "i", "j"]).where("a < b").select("a", "b")).distinct()


def _links(nodes: DataFrame) -> DataFrame:
    schema = pa.schema([("a", pa.string()), ("b", pa.string())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept = [(a, b) for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()) if same_core(a, b)]
        return pa.record_batch([pa.array(x, pa.string()) for x in (zip(*kept) if kept else ((), ()))], schema=schema)

    return map_texts(_candidates(nodes), "a", "a string, b string", run)


def found_kinds(names: DataFrame, least: int = 20, words: int = 3, lexicon: Lexicon = DEFAULT) -> list[str]:
    """Kinds of business that names(name) show themselves: words that end at least `least` names with different beginnings.

    Of endings that almost always stand in a longer one, the longer is the kind. The list is a vocabulary: more than MOST_KINDS are refused.
    """
    schema = pa.schema([("ending", pa.string()), ("start", pa.string())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for name in batch.column("name").to_pylist():
            w = tokens(name, lexicon)
            rows += [(" ".join(w[-k:]), " ".join(w[:-k])) for k in range(1, min(words, len(w) - 1) + 1)]
        return pa.record_batch([pa.array(x, pa.string()) for x in (zip(*rows) if rows else ((), ()))], schema=schema)

    counts = map_texts(names, "name", "ending string, start string", run).groupBy("ending").agg(F.countDistinct("start").alias("n")).where(F.col("n") >= least)
    found = {r.ending: r.n for r in counts.take(MOST_KINDS + 1)}
    if len(found) > MOST_KINDS:
        raise ValueError("kinds of business are few by contract")
    held = {e for e in found for longer, n in found.items() if longer.endswith(" " + e) and n >= 0.8 * found[e]}
    return sorted(set(found) - held)


def firms(names: DataFrame, lexicon: Lexicon = DEFAULT) -> DataFrame:
    """names(name), all different -> name, firm. Names of one firm share it."""
    parsed = stored(_parsed(names, lexicon), "parsed")
    nodes = stored(parsed.select("core", "business").distinct(), "cores")
    links = _links(nodes)
    # a name that stands for several cores (a nickname) ties none of them together: it takes the one that others bear
    found = components(links, nodes.select(F.col("core").alias("node")).distinct()).withColumnRenamed("node", "core").withColumnRenamed("component", "root")
    placed = stored(parsed.join(found, "core"), "placed")
    kinds = placed.where("business is not null").groupBy("root", "business").agg(F.countDistinct("name").alias("n"))
    # a name without business goes to the kind of which its core has the most spellings; to none where two have as many
    most = kinds.groupBy("root").agg(F.max_by("business", "n").alias("only"), F.max("n").alias("n"))
    tied = kinds.join(most, ["root", "n"]).groupBy("root").agg(F.count("*").alias("ties"))
    size = placed.groupBy("root").agg(F.count("*").alias("weight")).join(most, "root", "left").join(tied, "root", "left")
    known = placed.join(size, "root").withColumn("kind", F.coalesce("business", F.when(F.col("ties") == 1, F.col("only")).otherwise(F.lit(""))))
    best = known.groupBy("name").agg(F.max_by(F.concat_ws("|", "root", "kind"), F.struct("weight", "root")).alias("firm"))
    return best


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of different spellings of one firm in the three fields."""
    fields = (("target_list", "firm"), ("reference_list", "entity_name"), ("output_calls", "firm"))
    parts = [read(spark, sf_dir, table).select(F.col(c).alias("name")) for table, c in fields]
    names = stored(parts[0].union(parts[1]).union(parts[2]).where(r"name rlike '[\\pL\\pN]'").distinct(), "names")
    named = stored(firms(names), "firms")
    a, b = named.withColumnRenamed("name", "name_a"), named.withColumnRenamed("name", "name_b")
    return a.join(b, "firm").where("name_a < name_b").select("name_a", "name_b")
