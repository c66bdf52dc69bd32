"""Header CSV files of differing columns as one table, with types found from all values (SRC-1, SRC-2).

Every value has a kind - missing, boolean, whole number, number, date, text - and a column's kinds are kept as a set of bits.
Sets merge by OR, within a file, over files and over later ones, and the set alone gives the type: so types are folded in one
pass over all rows, whatever their order, and a column that a file lacks is missing in its rows.

Files are read per distinct header, by name; a header's fields may be quoted, line breaks inside fields are not supported.
"""
from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

# FIXED VALUES — texts that count as missing
MISSING = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

BOOLEAN, WHOLE, NUMBER, DATE, TEXT = 1, 2, 4, 8, 16
DATES = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss")
SPARK_TYPES = {"boolean": "boolean", "whole": "bigint", "number": "double", "date": "timestamp_ntz", "text": "string", "missing": "string"}
HEADERS = 1_000       # distinct headers at most: each is a scan


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def headers(spark: SparkSession, paths: str | list[str], pattern: str = "*.csv") -> DataFrame:
    """(path, header) of every file that has a line; only the first piece of each file is read."""
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(paths)
    first = lines.where("_metadata.file_block_start = 0").select(F.col("_metadata.file_path").alias("path"), "value", F.monotonically_increasing_id().alias("n"))
    head = F.regexp_replace("value", "^\\ufeff|\\r$", "")
    return first.where(F.trim("value") != "").groupBy("path").agg(F.min_by(head, "n").alias("header"))


def names_of(header: str) -> list[str]:
    """Column names of a header; a repeated one gets a number, an empty one its place."""
    out, seen = [], {}
    for i, name in enumerate(next(csv.reader([header]))):
        name = name or f"Unnamed: {i}"
        n = seen[name] = seen.get(name, -1) + 1
        out.append(f"{name}.{n}" if n else name)
    return out


def read_text(spark: SparkSession, paths: str | list[str], pattern: str = "*.csv", file_column: str | None = "file") -> DataFrame:
    """All files as text columns under their own headers' names, united by name; ``file_column`` holds a row's file."""
    found = headers(spark, paths, pattern)
    groups = found.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("header").limit(HEADERS + 1).collect()   # names only
    if not groups:
        raise FileNotFoundError(f"no file with a header at {paths}")
    if len(groups) > HEADERS:
        raise ValueError(f"more than {HEADERS} different headers")
    parts = []
    for g in groups:
        schema = StructType([StructField(n, StringType(), True) for n in names_of(g["header"])])
        rows = spark.read.option("header", True).option("escape", '"').option("nullValue", "\0").option("emptyValue", "").schema(schema).csv(g["paths"])
        parts.append(rows.withColumn(file_column, F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)) if file_column else rows)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def given(text: Column) -> Column:
    return text.isNotNull() & ~text.isin(*MISSING)


def date_of(text: Column) -> Column:
    return F.coalesce(*[F.try_to_timestamp(F.trim(text), F.lit(f)).cast("timestamp_ntz") for f in DATES])


def kind(text: Column) -> Column:
    """The bit of a value's kind; 0 for a missing one."""
    plain = F.trim(text)
    whole = plain.rlike(r"^[+-]?\d{1,19}$") & plain.try_cast("bigint").isNotNull()
    number = plain.rlike(r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)$")
    return (F.when(~given(text), F.lit(0)).when(text.isin("True", "TRUE", "true", "False", "FALSE", "false"), F.lit(BOOLEAN)).when(whole, F.lit(WHOLE))
            .when(number, F.lit(NUMBER)).when(plain.rlike(r"^\d{4}-\d{2}-\d{2}") & date_of(text).isNotNull(), F.lit(DATE)).otherwise(F.lit(TEXT))).cast("long")


def profile(df: DataFrame, by: str | None = None) -> DataFrame:
    """(column, kinds, n_rows, n_given) of every text column, or per value of ``by`` as well: states that ``merged`` adds up."""
    columns = [c for c in df.columns if c != by]
    aggs = [F.bit_or(kind(quoted(c))).alias(f"k{i}") for i, c in enumerate(columns)] + [F.count_if(given(quoted(c))).alias(f"g{i}") for i, c in enumerate(columns)]
    one = df.groupBy(*([by] if by else [])).agg(F.count(F.lit(1)).alias("n_rows"), *aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(f"k{i}"), F.lit(0)).alias("kinds"), F.col(f"g{i}").alias("n_given")) for i, c in enumerate(columns)])
    return one.select(*([by] if by else []), "n_rows", F.inline(rows))


def merged(profiles: DataFrame) -> DataFrame:
    """One profile per column from those of several files."""
    return profiles.groupBy("column").agg(F.bit_or("kinds").alias("kinds"), F.sum("n_rows").alias("n_rows"), F.sum("n_given").alias("n_given"))


def type_of(kinds: Column) -> Column:
    """The type of a column that has values of these kinds."""
    numbers = F.lit(WHOLE | NUMBER)
    return (F.when(kinds == 0, "missing").when(kinds == BOOLEAN, "boolean").when(kinds == WHOLE, "whole")
            .when(kinds.bitwiseAND(numbers) == kinds, "number").when(kinds == DATE, "date").otherwise("text"))


def types(profiles: DataFrame) -> DataFrame:
    """column, type, n_rows, n_given of ``merged`` profiles."""
    return profiles.select("column", type_of(F.col("kinds")).alias("type"), "n_rows", "n_given")


def typed(df: DataFrame, found: dict[str, str]) -> DataFrame:
    """Text columns cast to the types found; columns not named stay as they are."""
    def cast(c: str) -> Column:
        t = found.get(c)
        if t is None:
            return quoted(c)
        value = F.when(given(quoted(c)), quoted(c))
        return (date_of(value) if t == "date" else value if t in ("text", "missing") else F.trim(value).cast(SPARK_TYPES[t])).alias(c)
    return df.select(*map(cast, df.columns))


def read(spark: SparkSession, paths: str | list[str], pattern: str = "*.csv", file_column: str | None = "file") -> DataFrame:
    """All files as one table of typed columns: one pass finds the types (a row per column reaches the driver), the result is read lazily."""
    text = read_text(spark, paths, pattern, file_column)
    found = types(profile(text.drop(file_column) if file_column else text)).collect()
    return typed(text, {r["column"]: r["type"] for r in found})
