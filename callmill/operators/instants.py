"""Mixed timestamp texts to one instant in UTC (problem 5).

Every different (text, zone, date order) is parsed exactly once into a dictionary that can be kept and grown between
runs; rows then look their instant up. The parser is a cascade of anchored patterns, all JVM-side.

Defined results: null, blank or unparsable texts, impossible days and times, and texts without zone where no zone is
known give null. Repeated rows each get their instant. Empty tables give empty results. Columns of the input are kept
as they are; only `instant_us` is added, and an input column of that name is replaced.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callmill.common import read, salted_lookup, shared_dir, stored

#: Raise when the parser changes: kept dictionaries of other versions are not read.
PARSER_VERSION = 2

# Month names by number, in English, Spanish, French, German, Portuguese, Italian and Dutch.
MONTHS = {
    1: "january jan enero ene janvier janv januar jän jänner janeiro gennaio januari",
    2: "february feb febrero février fevrier févr fevr februar fevereiro febbraio februari",
    3: "march mar marzo mars märz maerz mrz março marco maart mrt",
    4: "april apr abril abr avril avr aprile",
    5: "may mayo mai maio maggio mei",
    6: "june jun junio juin juni junho giugno",
    7: "july jul julio juillet juil juli julho luglio",
    8: "august aug agosto ago août aout augustus",
    9: "september sep sept septiembre set septembre setembro settembre",
    10: "october oct octubre octobre oktober okt outubro ottobre",
    11: "november nov noviembre novembre novembro",
    12: "december dec diciembre dic décembre decembre déc dezember dez dezembro dicembre",
}

# Letter codes of zones (US, European, Japanese) and their offsets.
ZONE_CODES = {
    "Z": "+00:00", "UTC": "+00:00", "UT": "+00:00", "GMT": "+00:00", "WET": "+00:00", "WEST": "+01:00", "BST": "+01:00", "IST": "+01:00",
    "CET": "+01:00", "CEST": "+02:00", "MEZ": "+01:00", "MESZ": "+02:00", "EET": "+02:00", "EEST": "+03:00", "MSK": "+03:00",
    "EST": "-05:00", "EDT": "-04:00", "CST": "-06:00", "CDT": "-05:00", "MST": "-07:00", "MDT": "-06:00", "PST": "-08:00", "PDT": "-07:00",
    "AKST": "-09:00", "AKDT": "-08:00", "HST": "-10:00", "JST": "+09:00",
}

_TIME = r"(\d{1,2})[:hH](\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?(?: ?([AaPp])\.?[Mm]\.?(?![A-Za-z]))?(?: ?[Uu]hr)?"
_ZONE = r"(?: ?(Z|[+-]\d{2}:?\d{2}|[+-]\d{2}|[A-Z]{2,4}|[A-Za-z]+(?:/[A-Za-z_+-]+)+|\[[A-Za-z_/+-]+\])(?:\[[A-Za-z_/+-]+\])?)?"
_DAYNAME = r"(?:[\p{L}]{2,}\.?,? )?"
_WORD = r"([\p{L}]+)\.?"

#: (pattern, groups as year|month|day|hour|minute|second|fraction|am or pm|zone|kind). Kind s: the desk's order of parts 1, 2, 3.
_PATTERNS = [
    (rf"^(\d{{4}})-(\d{{1,2}})-(\d{{1,2}})(?:[T ]{_TIME})?{_ZONE}$", "$1|$2|$3|$4|$5|$6|$7|$8|$9|"),
    (r"^(\d{4})(\d{2})(\d{2})(?:T?(\d{2})(\d{2})(\d{2})?)?" + _ZONE + "$", "$1|$2|$3|$4|$5|$6|||$7|"),
    (rf"^(\d{{1,4}})/(\d{{1,2}})/(\d{{1,4}})(?:,? {_TIME})?{_ZONE}$", "$1|$2|$3|$4|$5|$6|$7|$8|$9|s"),
    (rf"^(\d{{1,2}})\.(\d{{1,2}})\.(\d{{2}}|\d{{4}})(?:,? {_TIME})?{_ZONE}$", "$3|$2|$1|$4|$5|$6|$7|$8|$9|"),
    (rf"^{_DAYNAME}(\d{{1,2}})(?:st|nd|rd|th|er|\.|º|ª)? (?:de |of )?{_WORD},? (?:de |del )?(\d{{4}})(?:,? (?:at |um |à |a las )?{_TIME})?{_ZONE}$", "$3|$2|$1|$4|$5|$6|$7|$8|$9|"),
    (rf"^{_DAYNAME}{_WORD} (\d{{1,2}})(?:st|nd|rd|th)?,? (\d{{4}})(?:,? (?:at )?{_TIME})?{_ZONE}$", "$3|$1|$2|$4|$5|$6|$7|$8|$9|"),
    (r"^(\d{4})年(\d{1,2})月(\d{1,2})日(?: ?(\d{1,2})[時时点](?:(\d{1,2})分)?(?:(\d{1,2})秒)?)?" + _ZONE + "$", "$1|$2|$3|$4|$5|$6|||$7|"),
]


def _literal_map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def _tidy(raw: Column) -> Column:
    """Trimmed, with any white space as one space and full-width digits and signs as ASCII."""
    plain = F.translate(raw, "０１２３４５６７８９：／－．−", "0123456789:/-.-")
    return F.regexp_replace(F.regexp_replace(plain, r"[\t-\r\x{1c}-\x20\x{85}\p{Z}\x{feff}]+", " "), "^ | $", "")


def parse(df: DataFrame) -> DataFrame:
    """df(raw, tz, date_order) -> the same with instant_us bigint, null where the text gives no instant."""
    text = F.col("_text")
    shaped = F.lit(None).cast("string")
    for pattern, order in reversed(_PATTERNS):
        shaped = F.when(text.rlike(pattern), F.regexp_replace(text, pattern, order)).otherwise(shaped)
    x = df.withColumn("_text", _tidy(F.col("raw"))).withColumn("_p", F.split(shaped, r"\|"))
    part = lambda i: F.nullif(F.col("_p")[i], F.lit(""))
    a, b, c = part(0), part(1), part(2)
    slash, order = part(9) == "s", F.when(F.length(part(0)) >= 3, "ymd").otherwise(F.col("date_order"))
    year = F.when(slash, F.when(order == "ymd", a).when(order.isin("dmy", "mdy"), c)).otherwise(a)
    month = F.when(slash, F.when(order == "mdy", a).when(order.isin("ymd", "dmy"), b)).otherwise(b)
    day = F.when(slash, F.when(order == "dmy", a).when(order == "ymd", c).when(order == "mdy", b)).otherwise(c)
    names = _literal_map({name: n for n, all_names in MONTHS.items() for name in all_names.split()})
    number = lambda v: v.try_cast("int")
    month_no = F.when(month.rlike(r"^\d+$"), number(month)).otherwise(F.try_element_at(names, F.lower(month)))
    year_no = F.when(F.length(year) == 2, number(year) + 2000).when(F.length(year) == 4, number(year))
    half, hour = F.lower(part(7)), number(part(3))
    hour_no = F.when(half.isNull(), hour).when(hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0))
    hour_no = F.when(part(3).isNull(), F.lit(0)).otherwise(hour_no)
    seconds = F.concat(F.coalesce(part(5), F.lit("0")), F.lit("."), F.substring(F.rpad(F.coalesce(part(6), F.lit("0")), 9, "0"), 1, 6)).try_cast("decimal(8,6)")
    zone = F.regexp_replace(part(8), r"[\[\]]", "")
    offset = F.regexp_replace(F.regexp_replace(zone, r"^([+-]\d{2})$", "$1:00"), r"^([+-]\d{2})(\d{2})$", "$1:$2")
    stated = F.when(zone.rlike("^[A-Z]{1,4}$"), F.try_element_at(_literal_map(ZONE_CODES), zone)).otherwise(offset)
    tz = F.when(part(8).isNull(), F.col("tz")).otherwise(stated)
    sound = F.coalesce(number(part(4)), F.lit(0)).between(0, 59) & (F.coalesce(number(part(5)), F.lit(0)) < 60) & hour_no.between(0, 23)
    minute = F.coalesce(number(part(4)), F.lit(0))
    dated = F.when(sound & tz.isNotNull(), F.unix_micros(F.try_make_timestamp(year_no, month_no, number(day), hour_no, minute, seconds, tz)))
    days = text.try_cast("decimal(20,10)")
    serial = F.expr("try_add(timestamp_ntz '1899-12-30 00:00:00', make_interval(0, 0, 0, cast(floor(try_cast(_text as decimal(20,10))) as int), 0, 0, 0))")
    tick = F.round((days - F.floor(days)) * F.lit(86400)).cast("int")
    local = F.unix_micros(F.try_make_timestamp(F.year(serial), F.month(serial), F.day(serial), (tick / 3600).cast("int"), ((tick % 3600) / 60).cast("int"), (tick % 60).cast("decimal(8,6)"), F.col("tz")))
    unix = (
        F.when(text.rlike(r"^-?\d{9,10}(\.\d+)?$"), (days * 1_000_000).cast("bigint"))
        .when(text.rlike(r"^\d{12,13}$"), text.try_cast("bigint") * 1000)
        .when(text.rlike(r"^\d{16}$"), text.try_cast("bigint"))
        .when(text.rlike(r"^\d{19}$"), F.floor(text.try_cast("decimal(20,0)") / 1000).cast("bigint"))
        .when(text.rlike(r"^\d{5}(\.\d+)?$") & (tick < 86400), local)
    )
    return x.withColumn("instant_us", F.coalesce(unix, dated)).drop("_text", "_p")


def normalise(rows: DataFrame, raw: str, tz: str, date_order: str, by: str, dictionary: str | None = None) -> DataFrame:
    """rows with instant_us. dictionary: folder of the kept dictionary; only texts that it lacks are parsed and added.

    Its keys are 128-bit digests of text, zone and order. Two runs that add a text at once give it the same instant twice;
    reading keeps one.
    """
    spark = rows.sparkSession
    path = f"{dictionary or shared_dir(spark) + '/instants-' + uuid.uuid4().hex}/v{PARSER_VERSION}"
    digest = F.md5(F.to_json(F.struct(F.col(raw).alias("r"), F.col(tz).alias("z"), F.col(date_order).alias("o"))))
    keyed = stored(rows.drop("instant_us").withColumn("_key", digest), "keyed")
    new = keyed.where(F.col(raw).isNotNull()).groupBy("_key").agg(F.first(raw).alias("raw"), F.first(tz).alias("tz"), F.first(date_order).alias("date_order"))
    known = _known(spark, path)
    if known is not None:
        new = new.join(known.select("_key"), "_key", "left_anti")
    # a folder for each addition: Spark takes two reads of one folder for the same table, whatever was added between them
    parse(new).select("_key", "instant_us").write.parquet(f"{path}/added={uuid.uuid4().hex}")
    found = _known(spark, path).groupBy("_key").agg(F.first("instant_us").alias("instant_us"))
    return salted_lookup(keyed, found, "_key", F.col(by)).drop("_key")


def _known(spark: SparkSession, path: str) -> DataFrame | None:
    """What the dictionary holds now, or None where there is none."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    added = [x.getPath().toString() for x in files.listStatus(where) if x.isDirectory()] if files.exists(where) else []
    return spark.read.schema("_key string, instant_us bigint").parquet(*sorted(added)) if added else None


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problem 5 over target_list, reference_list and output_calls: one row for each row whose text gives an instant.

    The tables share a dictionary: each adds the texts that those before it lack.
    """
    desks = read(spark, sf_dir, "desks").select("desk", "tz", "date_order")
    dictionary, found = f"{shared_dir(spark)}/instants-{uuid.uuid4().hex}", []
    for table, key, raw in (("target_list", "list_row", "published_at"), ("reference_list", "ref_row", "pub_date"), ("output_calls", "call_id", "out_date")):
        rows = read(spark, sf_dir, table).select(F.lit(table).alias("table_name"), F.col(key).cast("bigint").alias("row_key"), F.col(raw).alias("raw"), "desk")
        rows = salted_lookup(rows.where("row_key is not null").dropDuplicates(["row_key"]), desks, "desk", F.col("row_key"))
        found.append(normalise(rows, "raw", "tz", "date_order", "row_key", dictionary).where("instant_us is not null").select("table_name", "row_key", "instant_us"))
    return found[0].unionByName(found[1]).unionByName(found[2])
