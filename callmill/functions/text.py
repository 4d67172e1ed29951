"""Text expressions. All but NFKC of texts beyond ASCII are built-in expressions; null in, null out."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

#: White space as Unicode has it, which Java's \\s does not cover.
WS = r"[\t-\r\x{1c}-\x20\x{85}\p{Z}]"
WORD = r"[\p{L}\p{N}_]"
# Words that carry no meaning in evidence, and in leaf names.
STOPWORDS = "the and for from with that this are was were".split()
LEAF_STOPWORDS = "of and the inc for vs".split()
# What makes a locator of a table or picture specific.
VISUAL_WORDS = "table figure fig. grid chart dashboard matrix caption heading panel view".split()


def _composers():
    """The composition of a column of texts, and of one of lists of texts. Made inside a function, so that workers need no module of ours for them."""

    def composed(text):
        return text if text is None or text.isascii() else unicodedata.normalize("NFKC", text)

    @F.pandas_udf(StringType())
    def one(text: pd.Series) -> pd.Series:
        return text.map(composed)

    @F.pandas_udf(ArrayType(StringType()))
    def each(texts: pd.Series) -> pd.Series:
        return texts.map(lambda ts: ts if ts is None else [composed(t) for t in ts])

    return one, each


_nfkc, _nfkc_all = _composers()


def _plain(text: Column) -> Column:
    """All characters are ASCII, which composition leaves as they are."""
    return F.octet_length(text) == F.length(text)


def nfkc(text: Column) -> Column:
    """Compatibility composition, the one step that Spark has no expression for. ASCII texts are not sent to Python."""
    return F.when(_plain(text), text).otherwise(_nfkc(F.when(~_plain(text), text)))


def nfkc_all(texts: Column) -> Column:
    """The same of each text of an array."""
    plain = _plain(F.array_join(texts, "", ""))
    return F.when(plain, texts).otherwise(_nfkc_all(F.when(~plain, texts)))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{WS}+|{WS}+$", "")


def normalize_composed(text: Column) -> Column:
    """normalize_quote of a text that is composed already."""
    # Curly quotes, the soft hyphen (deleted) and dashes.
    x = F.translate(text, "‘’“”‐‑‒–—―−­", "''\"\"-------")
    x = F.regexp_replace(x, rf"({WORD}-){WS}*\n{WS}*({WORD})", "$1$2")
    x = F.regexp_replace(x, rf"{WS}+", " ")
    for _ in range(2):  # a letter between two hyphens belongs to both
        x = F.regexp_replace(x, rf"({WORD})-({WORD})", "$1$2")
    return F.trim(x)  # only single spaces are left


def normalize_quote(text: Column) -> Column:
    """A quote as it is compared: composed, plain quotes and dashes, joined line breaks, single spaces, no hyphens inside words."""
    return normalize_composed(nfkc(text))


def normalize_spans(spans: Column) -> Column:
    """normalize_quote of each span."""
    return F.transform(nfkc_all(spans), normalize_composed)


def meaningful_tokens(text: Column) -> Column:
    """Tokens of at least three characters that are no stopwords, repeats kept. Null text gives an empty array."""
    return tokens_of(normalize_quote(text))


def tokens_of(normalized: Column) -> Column:
    """The same of a text that is normalised already."""
    found = F.regexp_extract_all(F.lower(normalized), F.lit(r"[a-z0-9][a-z0-9-]{2,}"), F.lit(0))
    return F.coalesce(F.filter(found, lambda t: ~t.isin(STOPWORDS)), F.array().cast("array<string>"))


def slugify(text: Column) -> Column:
    x = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.coalesce(F.nullif(x, F.lit("")), F.lit("source"))


def lookup_key(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), "[^a-z0-9]", "")


def markup_counts(html: Column, tags: tuple[str, ...] = ("img", "svg", "canvas", "figure")) -> Column:
    """map of tag -> opening tags in the page."""
    return F.create_map(*[x for t in tags for x in (F.lit(t), F.regexp_count(html, F.lit(rf"(?i)<{t}\b")))])


def visual_heavy(markup: Column, least: int = 5) -> Column:
    """Enough pictures; vector graphics don't count, missing keys are 0, no map is no picture."""
    parts = [F.coalesce(F.try_element_at(markup, F.lit(t)), F.lit(0)) for t in ("img", "canvas", "figure")]
    return parts[0] + parts[1] + parts[2] >= least


def cited_page(locator: Column) -> Column:
    return F.nullif(F.regexp_extract(locator, r"(?i)p\.?\s*(\d+)", 1), F.lit("")).try_cast("int")


def visual_locator(locator: Column) -> Column:
    """Names a table or picture: not a bare page or range of characters, but a keyword or a dash."""
    x = F.lower(strip(F.coalesce(locator, F.lit(""))))
    bare = x.rlike(r"^p\.?\s*\d+$") | x.rlike(r"^char:\d+-\d+$")
    named = F.contains(x, F.lit(" - ")) | F.contains(x, F.lit("—")) | F.contains(x, F.lit("–"))
    for word in VISUAL_WORDS:
        named = named | F.contains(x, F.lit(word))
    return ~bare & named


def format_number(x: Column) -> Column:
    """A number in six significant digits without trailing zeros, in powers of ten below 0.0001 and from a million on."""
    x = x.cast("double")
    power = F.format_string("%.5e", F.abs(x))
    digits, exponent = F.concat(F.substring(power, 1, 1), F.substring(power, 3, 5)), F.regexp_extract(power, r"e([+-]\d+)$", 1).try_cast("int")
    placed = (
        F.when(exponent.between(0, 5), F.concat(F.left(digits, exponent + 1), F.lit("."), F.substring(digits, exponent + 2, F.lit(6))))
        .when(exponent.between(-4, -1), F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)).otherwise(F.substring(power, 1, 7))
    )
    bare = F.concat(F.when(x < 0, "-").otherwise(""), F.regexp_replace(placed, r"\.?0*$", ""))
    return F.when(x == 0, "0").when(x.isNotNull(), F.when(exponent.between(-4, 5), bare).otherwise(F.concat(bare, F.regexp_extract(power, "e.*$", 0))))


def leaf_tokens(name: Column) -> Column:
    found = F.regexp_extract_all(F.lower(name), F.lit("[a-z0-9]+"), F.lit(0))
    return F.filter(found, lambda t: (F.length(t) >= 2) & ~t.isin(LEAF_STOPWORDS))


def leaf_overlap(leaf: Column, evidence: Column) -> Column:
    """How many tokens of the leaf's name some word of the normalised evidence equals or, from four letters on, extends or begins."""
    words = F.array_distinct(F.coalesce(F.regexp_extract_all(F.lower(evidence), F.lit("[a-z0-9]+"), F.lit(0)), F.array().cast("array<string>")))

    def hit(t: Column) -> Column:
        return F.exists(words, lambda w: (t == w) | ((F.length(t) >= 4) & (F.length(w) >= 4) & (F.startswith(w, t) | F.startswith(t, w))))

    return F.coalesce(F.size(F.filter(leaf_tokens(leaf), hit)), F.lit(0))


def fill_template(template: Column, values: dict[str, Column]) -> Column:
    """{{key}} replaced one key after the other, so that a value's own {{other}} is filled by a later one."""
    for key, value in values.items():
        template = F.replace(template, F.lit("{{" + key + "}}"), value)
    return template


def fenced_json(text: Column) -> Column:
    """JSON text without a code fence around it."""
    x = strip(text)
    fenced = F.regexp_replace(F.regexp_replace(x, r"^```[^\n]*\n?", ""), r"\n?```\s*$", "")
    return strip(F.when(F.startswith(x, F.lit("```")), fenced).otherwise(x))
