"""Sources of mentions: two layouts behind one set of columns, deltas by date, files and lookups."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from kinfold.functions.people import mention_id, record_id, unquoted


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


MENTIONS = strings("uuid", "patent_id", "document_number", "rawlocation_id", "name_first", "name_last", "organization", "sequence", "version_indicator")
INVENTOR_FILE = strings("uuid", "patent_id", "inventor_id", "rawlocation_id", "name_first", "name_last", "sequence", "rule_47", "deceased")
ASSIGNEE_FILE = strings("uuid", "patent_id", "assignee_id", "rawlocation_id", "type", "name_first", "name_last", "organization", "sequence")
LAWYER_FILE = strings("uuid", "lawyer_id", "patent_id", "name_first", "name_last", "organization", "country", "sequence")
LOCATION_FILE = strings("id", "location_id", "city", "state", "country", "latlong")
FAMILY_FILE = strings("number", "patent", "kind", "docdb", "inpadoc")
PAIR_FILE = strings("mention", "entity")
ENTITY_FILE = strings("uuid", "organization", "name_first", "name_last", "count", "doc_date", "id")


@dataclass(frozen=True)
class Source:
    """One source table: where it is (None: absent) and how its columns map to the common ones."""

    name: str
    location: str | None
    columns: dict[str, str | Column] = field(default_factory=dict)
    date: str = "version_indicator"
    options: dict[str, str] | None = None

    def read(self, spark: SparkSession, schema: T.StructType = MENTIONS) -> DataFrame:
        """The common columns; an absent source is empty, a column without a mapping null."""
        if self.location is None or self.location == "none":
            return spark.createDataFrame([], schema)
        if self.location.startswith("jdbc:"):
            rows = spark.read.format("jdbc").option("url", self.location).options(**(self.options or {})).load()
        else:
            rows = spark.read.parquet(self.location)
        return common(rows, self.columns, schema)


def common(rows: DataFrame, columns: dict[str, str | Column], schema: T.StructType) -> DataFrame:
    def one(f: T.StructField) -> Column:
        c = columns.get(f.name)
        c = F.lit(None) if c is None else F.col(c) if isinstance(c, str) else c
        return c.cast(f.dataType).alias(f.name)

    return rows.select(*[one(f) for f in schema.fields])


#: The two layouts: issued documents count sequences from 0, applications from 1.
ISSUED = {"uuid": "uuid", "patent_id": "patent_id", "rawlocation_id": "rawlocation_id", "name_first": "name_first", "name_last": "name_last", "sequence": "sequence", "version_indicator": "version_indicator"}


def applied() -> dict[str, str | Column]:
    return {"uuid": "id", "document_number": "document_number", "rawlocation_id": "rawlocation_id", "name_first": "name_first", "name_last": "name_last", "sequence": F.col("sequence").cast("int") - 1, "version_indicator": "version_indicator"}


def dated(rows: DataFrame, column: str, end=None, start=None) -> DataFrame:
    """All rows, those up to `end`, or those from `start` to `end`, both included."""
    if end is None:
        return rows
    return rows.filter(F.col(column) <= F.lit(end)) if start is None else rows.filter(F.col(column).between(F.lit(start), F.lit(end)))


def union(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def identified(rows: DataFrame) -> DataFrame:
    """Adds mention_id and record_id."""
    ids = (F.col("patent_id"), F.col("document_number"))
    return rows.withColumns({"mention_id": mention_id(*ids, F.col("sequence")), "record_id": record_id(*ids)})


def lookup(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of the ids, of repeated keys the last by all columns; no list of ids passes the driver."""
    found = rows.join(ids.select(key).distinct(), key, "left_semi")
    others = [F.col(c).desc() for c in rows.columns if c != key]
    return found.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(*others))).filter("_r = 1").drop("_r")


def of_canopies(canopies: DataFrame, mentions: DataFrame, wanted: DataFrame) -> DataFrame:
    """Mentions of the wanted canopies."""
    return canopies.join(wanted, "canopy", "left_semi").join(mentions, "uuid")


def tsv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True, first: int | None = None, last: int | None = None, quote: str = '"') -> DataFrame:
    """Tab-separated rows; those of a wrong arity go. first and last choose lines of each file by number from 0, both
    included, a header not counted; quote='' reads quotation marks as they are."""
    text = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    rows = spark.read.csv(path, sep="\t", header=header, schema=text, mode="PERMISSIVE", columnNameOfCorruptRecord="_bad", quote=quote)
    if first is not None or last is not None:
        rows = numbered(rows).filter(F.col("_n").between(first or 0, (1 << 62) if last is None else last)).drop("_n")
    # all columns are named, since the arity of a line shows only where none is pruned
    return rows.filter(F.col("_bad").isNull() & (F.concat_ws("", *schema.names) >= "")).drop("_bad")


def numbered(rows: DataFrame) -> DataFrame:
    """Adds _n, each row's number within its file from 0: its number in its part of the file, and the rows of the parts before."""
    held = rows.select("*", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_m"))
    parts = held.groupBy("_f", "_b").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy("_f").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_f", "_b", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_s"))
    own = F.row_number().over(Window.partitionBy("_f", "_b").orderBy("_m")) - 1
    return held.withColumn("_r", own).join(parts, ["_f", "_b"]).withColumn("_n", F.col("_r") + F.col("_s")).drop("_f", "_b", "_m", "_r", "_s")


def families(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(family, members) by the narrow and by the wide kind of family."""
    rows = spark.read.csv(path, header=True, schema=FAMILY_FILE).filter("patent IS NOT NULL")
    return tuple(rows.filter(F.col(k).isNotNull()).groupBy(F.col(k).alias("family")).agg(F.collect_list("patent").alias("members")) for k in ("docdb", "inpadoc"))


def codes(spark: SparkSession, path: str, names: tuple[str, ...] = ("name", "code")) -> DataFrame:
    """Reference tables of places; quoted fields may hold commas, empty fields stay in place."""
    return spark.read.csv(path, schema=strings(*names), quote='"')


def dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(position, word) of a list with one word or phrase on each line, or of a JSON object's keys with their values."""
    if path.endswith(".json"):
        whole = spark.read.text(path, wholetext=True)
        return whole.select(F.posexplode(F.map_entries(F.from_json("value", "map<string,string>"))).alias("position", "e")).select("position", F.col("e.key").alias("word"), F.col("e.value").alias("value"))
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("position", "word"))
    return rows.select("position", F.trim("word").alias("word")).filter("word != ''")


def results(spark: SparkSession, folder: str, wanted: str = "job", unwanted: tuple[str, ...] = ("internals",)) -> DataFrame:
    """Result files of a folder by their names."""
    rows = spark.read.option("recursiveFileLookup", "true").parquet(folder).withColumn("_f", F.col("_metadata.file_path"))
    rows = rows.filter(F.contains("_f", F.lit(wanted)))
    for u in unwanted:
        rows = rows.filter(~F.contains("_f", F.lit(u)))
    return rows.drop("_f")


def newer_than(rows: DataFrame, moment: str) -> DataFrame:
    """Rows of files modified after the moment."""
    return rows.filter(F.col("_metadata.file_modification_time") > F.to_timestamp(F.lit(moment)))


def line_count(spark: SparkSession, path: str) -> int:
    """Records of a quoted file with a header."""
    return spark.read.csv(path, header=True, multiLine=True, escape='"').count()


def page(rows: DataFrame, order: list[str], offset: int, limit: int) -> DataFrame:
    return rows.orderBy(*order).offset(offset).limit(limit)


def assignee_rows(rows: DataFrame) -> DataFrame:
    """Lines of the assignee layout: a record id of more than 9 characters is an application's."""
    own = unquoted(F.col("patent_id"))
    long = F.length(own) > 9
    return rows.withColumns({"document_number": F.when(long, own), "patent_id": F.when(~long, own)})
