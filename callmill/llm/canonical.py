"""Mapping free-entered values to a canonical list (problem 4), in SQL.

A reference list is a table of strings with their entries. Strings in the orders and wordings that people type are made
by rule from a table of words (Words, by default that of leaf_words.txt), and the caller may give more of them (aliases).
A value is stripped of wrapping phrases and compared by a partition-based pigeonhole join:
every reference string is cut into k + 1 = 3 segments, so whatever two edits touch, one segment stays as it is; values
join by equal substrings at the positions that the edits allow, and built-in levenshtein verifies. Accepted are one
edit, or two edits that swap neighbouring characters. Values without a partner are reported through an anti-join.

Work is done once for each different value. All joins are on equality.

Defined results: null and blank values, and values that are a leaf exactly, are no cases; a value that fits no leaf or
equally well several gets leaf 0; values shorter than 5 characters must fit exactly. Repeated rows count once. Empty
tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callmill.common import read, salted_lookup, stored

TABLE = Path(__file__).with_name("leaf_words.txt")

#: Values and reference strings shorter than this must be equal.
LEAST_FUZZY = 5


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Words:
    """Sections of key -> values of a table of words, and patterns of the phrases that may stand before and after a value."""

    tables: dict[str, dict[str, tuple[str, ...]]] = field(default_factory=dict)
    before: tuple[str, ...] = ()
    after: tuple[str, ...] = ()

    @staticmethod
    def read(path: Path = TABLE) -> Words:
        found: dict[str, list[str]] = {}
        for line in path.read_text(encoding="utf-8").splitlines():
            if line.startswith("["):
                section = found.setdefault(line.strip("[]"), [])
            elif line.strip() and not line.startswith("#"):
                section.append(line.strip())
        rows = {k: [x.split(" = ", 1) for x in v] for k, v in found.items() if k not in ("before", "after")}
        tables = {k: {key: tuple(x.strip() for x in values.split(",")) for key, values in v} for k, v in rows.items()}
        return Words(tables, tuple(found.get("before", ())), tuple(found.get("after", ())))

    def pairs(self, section: str, own: bool = False) -> list[tuple[str, str]]:
        """(key, value) of a section; own: with each key as a value of itself."""
        return [(k, x) for k, xs in self.tables.get(section, {}).items() for x in ((k, *xs) if own else xs)]


def plain(column: str) -> str:
    """SQL: lower case, with single spaces for whatever is no letter or digit."""
    return f"trim(regexp_replace(regexp_replace(lower({column}), '[^\\\\pL\\\\pN]+', ' '), ' in ', ' '))"


def stripped(column: str, words: Words) -> str:
    """SQL: a plain value without wrapping phrases."""
    if words.before:
        column = f"regexp_replace({column}, {_quoted(f'^(?:(?:{"|".join(words.before)}) )+(?=.)')}, '')"
    return f"regexp_replace({column}, {_quoted(f'(?: (?:{"|".join(words.after)}))+$')}, '')" if words.after else column


REFERENCES = f"""
WITH leaves AS (SELECT leaf_no, sub_asset_class AS leaf FROM {{taxonomy}} WHERE sub_asset_class IS NOT NULL),
splits AS (SELECT leaf_no, leaf, substring(leaf, 1, p - 1) AS head, substring(leaf, p + 1) AS tail FROM leaves LATERAL VIEW explode(filter(sequence(1, length(leaf)), x -> substring(leaf, x, 1) = ' ')) AS p),
markets AS (SELECT key AS market, key AS place FROM {{adjectives}} UNION SELECT key, word FROM {{adjectives}}),
strings AS (
  SELECT leaf_no, leaf AS s FROM leaves
  UNION ALL SELECT leaf_no, concat(substring(leaf, instr(leaf, ' ') + 1), ' ', substring_index(leaf, ' ', 1)) FROM leaves WHERE instr(leaf, ' ') > 0
  UNION ALL SELECT leaf_no, explode(array(concat(place, ' ', word), concat(word, ' ', place))) FROM splits JOIN {{kinds}} ON tail = key JOIN markets ON head = market
  UNION ALL SELECT leaf_no, concat(head, ' ', word) FROM splits JOIN {{endings}} ON tail = key
  UNION ALL SELECT leaf_no, explode(array(word, concat(word, ' eur long'), concat(substring(leaf, 1, 4), ' ', substring_index(leaf, ' ', -1)))) FROM leaves JOIN {{codes}} ON leaf = key
  UNION ALL SELECT leaf_no, explode(array(concat(a.key, ' ', substring_index(leaf, ' ', -1)), concat(substring_index(leaf, ' ', -1), ' ', a.key))) FROM leaves JOIN {{codes}} c ON leaf = c.key JOIN {{adjectives}} a ON substring_index(leaf, ' ', 1) = a.word
  UNION ALL SELECT leaf_no, word FROM leaves JOIN {{names}} ON leaf = key
  UNION ALL SELECT leaf_no, text FROM {{aliases}} WHERE text IS NOT NULL)
SELECT DISTINCT leaf_no, {plain('s')} AS ref FROM strings"""

#: Candidates at their distance. A shift is how far an insertion or deletion before a segment moves it.
MATCHES = f"""
WITH segments AS (
  SELECT ref, leaf_no, length(ref) AS n, i, substring(ref, (length(ref) * i div 3) + 1, (length(ref) * (i + 1) div 3) - (length(ref) * i div 3)) AS part
  FROM {{references}} LATERAL VIEW explode(array(0, 1, 2)) AS i WHERE length(ref) >= {LEAST_FUZZY}),
rest AS (SELECT * FROM {{values}} v WHERE length(v.core) >= {LEAST_FUZZY} AND NOT EXISTS (SELECT 1 FROM {{references}} r WHERE r.ref = v.core)),
probes AS (
  SELECT DISTINCT core, t.n, i, substring(core, (t.n * i div 3) + 1 + t.shift, (t.n * (i + 1) div 3) - (t.n * i div 3)) AS part
  FROM rest
  LATERAL VIEW inline(array(struct(length(core), 0), struct(length(core) - 1, 0), struct(length(core) - 1, 1), struct(length(core) + 1, 0), struct(length(core) + 1, -1))) t AS n, shift
  LATERAL VIEW explode(array(0, 1, 2)) AS i
  WHERE (t.n * i div 3) + 1 + t.shift >= 1),
pairs AS (SELECT DISTINCT core, ref, leaf_no FROM probes JOIN segments USING (n, i, part)),
near AS (
  SELECT core, leaf_no, levenshtein(core, ref, 2) AS d, ref FROM pairs),
fits AS (
  SELECT core, leaf_no, 0 AS d FROM {{values}} v JOIN {{references}} r ON r.ref = v.core
  UNION ALL SELECT core, leaf_no, 1 FROM near WHERE d = 1 OR d = 2 AND length(core) = length(ref) AND array_sort(split(core, '')) = array_sort(split(ref, '')))
SELECT core, if(count(DISTINCT leaf_no) = 1, min(leaf_no), 0) AS leaf_no FROM fits GROUP BY core"""


def references(taxonomy: DataFrame, words: Words, aliases: DataFrame | None = None) -> DataFrame:
    """leaf_no, ref: the strings that stand for each leaf of taxonomy(leaf_no, sub_asset_class)."""
    spark = taxonomy.sparkSession
    table = lambda name, own=False: spark.createDataFrame(words.pairs(name, own), "key string, word string")
    given = spark.createDataFrame([], "leaf_no int, text string") if aliases is None else aliases.select("leaf_no", "text")
    tables = {"adjectives": table("adjectives"), "kinds": table("kinds", True), "endings": table("endings"), "codes": table("codes"), "names": table("names")}
    return spark.sql(REFERENCES, taxonomy=taxonomy, aliases=given, **tables)


def canonicalise(values: DataFrame, taxonomy: DataFrame, aliases: DataFrame | None = None, words: Words | None = None) -> DataFrame:
    """values(value), all different -> value, leaf_no; 0 for those that the anti-join leaves unmatched.

    taxonomy(leaf_no, sub_asset_class) is the reference list, aliases(leaf_no, text) are further strings for its entries,
    words the table from which more are made; Words() makes none.
    """
    spark, words = values.sparkSession, Words.read() if words is None else words
    strings = stored(references(taxonomy, words, aliases), "references")
    cored = stored(values.withColumn("core", F.expr(stripped(plain("value"), words))), "values")
    matches = stored(spark.sql(MATCHES, references=strings, values=cored.select("core").distinct()), "matches")
    return spark.sql(
        """SELECT value, leaf_no FROM {values} JOIN {matches} USING (core)
        UNION ALL SELECT value, 0 FROM {values} v LEFT ANTI JOIN {matches} m ON v.core = m.core""",
        values=cored, matches=matches,
    )


CASES = r"""
SELECT failure_id, field, value FROM (SELECT DISTINCT failure_id, sub_asset_raw, sub_asset_class FROM {failures} WHERE failure_id IS NOT NULL)
UNPIVOT (value FOR field IN (sub_asset_raw, sub_asset_class)) AS u
WHERE value RLIKE '[^\\s\\pZ]' AND NOT EXISTS (SELECT 1 FROM {taxonomy} t WHERE t.sub_asset_class = u.value)"""


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaf, or 0, of each value of the two sub-asset fields that is no leaf."""
    failures, taxonomy = read(spark, sf_dir, "failures"), read(spark, sf_dir, "taxonomy").select("leaf_no", "sub_asset_class")
    cases = spark.sql(CASES, failures=failures, taxonomy=taxonomy)
    leaves = stored(canonicalise(cases.select("value").distinct(), taxonomy), "leaves")
    return salted_lookup(cases, leaves, "value", F.xxhash64("failure_id", "field")).select(F.col("failure_id").cast("bigint").alias("failure_id"), "field", F.col("leaf_no").cast("int").alias("leaf_no"))
