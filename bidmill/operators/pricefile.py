"""The price file: export, scan, header, parse and merge.

A price file line is ``key parts TAB sid:mult:baseline,sid:mult:baseline,...``
under a one-line header of ``"name":Type`` pairs (exactly one ``Array``).
Reading merges lines: for (strategy, dimension, value) the last entry wins;
a strategy's baseline comes from the first line that names it, and inside
that line from its last entry.

A key is one line, as long as its strategies need. Its entries are made where
the entry dedup puts them, spread by (key, strategy, multiplier), and each task
gathers its own share first; only the finished texts of a key meet in the task
that writes its line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidmill.functions.text import make_key, value_string
from bidmill.session import written

# Fixed value that must equal the reference's: the header of the site-domain
# price file.
SITE_DOMAIN_HEADER = '"site_domain_id2":Long\t"strategy_id:bid_price_multiplier":Array'
ARRAY_COLUMN = "strategy_id:bid_price_multiplier"


def header_for(dimensions: list[str], dim_type: str = "Long") -> str:
    return "\t".join([f'"{d}":{dim_type}' for d in dimensions] + [f'"{ARRAY_COLUMN}":Array'])


def price_entries(priced: DataFrame, dims_col: str = "dims") -> DataFrame:
    """F2 + P12: key per row, one row per (key, strategy, multiplier).

    The rows are dealt by all three columns before the dedup, whatever the
    input's partitioning: a hot strategy or key never stays in one task."""
    by = ["key", "strategy_id", "multiplier"]
    keyed = priced.select(make_key(dims_col).alias("key"), "strategy_id", "multiplier", "baseline")
    return keyed.repartition(*by).dropDuplicates(by)


def price_lines(entries: DataFrame) -> DataFrame:
    """A6 + F3: (key, line); entries inside a line by (strategy_id, multiplier)."""
    e = F.struct("strategy_id", "multiplier",
                 value_string("strategy_id", "multiplier", "baseline").alias("vs"))
    g = entries.groupBy("key").agg(F.array_sort(F.collect_list(e)).alias("es"))
    return g.select("key", F.concat_ws("\t", F.col("key"), F.array_join(
        F.transform("es", lambda x: x["vs"]), ",")).alias("line"))


def export_price_file(lines: DataFrame, path: str) -> None:
    """K7 + O2: lines in key order (a distributed range sort), text files.
    The range sort samples its input in a job of its own, so the lines are
    written first instead of being built twice."""
    written(lines, "price-lines").orderBy("key").select("line").write.mode("overwrite").text(path)


def write_header(spark: SparkSession, header: str, path: str) -> None:
    spark.createDataFrame([(header,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with their file order (number of the part file, file,
    split start, position)."""
    t = spark.read.text(path)
    number = F.regexp_extract(F.col("_metadata.file_name"), r"part-([0-9]+)", 1)
    return t.select(
        F.struct(F.nullif(number, F.lit("")).cast("long").alias("part"),
                 F.col("_metadata.file_path").alias("file"),
                 F.col("_metadata.file_block_start").alias("block"),
                 F.monotonically_increasing_id().alias("seq")).alias("line_no"),
        F.trim(F.col("value")).alias("text")).where(F.col("text") != "")


def parse_header(header_lines: DataFrame, text_col: str = "text", keep=()) -> DataFrame:
    """S3: (idx, name, type, is_array) per header part (plus ``keep`` columns)."""
    p = header_lines.select(*keep, F.posexplode(F.split(F.col(text_col), "\t")).alias("idx", "part"))
    p = p.select(*keep, "idx", F.trim("part").alias("part"))
    return p.select(*keep, "idx",
                    F.regexp_extract("part", r'^"([^"]+)"', 1).alias("name"),
                    F.regexp_extract("part", r':([A-Za-z]+)$', 1).alias("type"),
                    (F.regexp_extract("part", r':([A-Za-z]+)$', 1) == "Array").alias("is_array"))


def header_layout(spark: SparkSession, header_path: str) -> tuple[int, list[tuple[int, str]]]:
    """Array index and (index, name) of the dimension columns. The header is a
    single line (schema metadata), read on the driver like a schema."""
    rows = parse_header(read_lines(spark, header_path)).collect()  # one line: its columns
    arr = [r.idx for r in rows if r.is_array]
    if len(arr) != 1:
        raise ValueError("price file header needs exactly one Array column")
    return arr[0], [(r.idx, r.name) for r in rows if not r.is_array]


def parse_price_lines(lines: DataFrame, array_idx: int, dims: list[tuple[int, str]]) -> DataFrame:
    """one row per (line entry, dimension column):
    line_no, pos, strategy_id, dimension, value, multiplier, baseline.

    A line is cut into its parts below the generator: beside it, they would be
    cut again for each entry, and a line's work would grow with its square."""
    parts = F.split(F.col("text"), "\t")
    by_line = lines.select(
        "line_no",
        F.array(*[F.struct(F.lit(name).alias("dimension"), F.get(parts, i).alias("value"))
                  for i, name in dims]).alias("dims"),
        F.split(F.get(parts, array_idx), ",").alias("entries"))
    by_entry = by_line.select("line_no", "dims", F.posexplode("entries").alias("pos", "entry"))
    e = F.split(F.col("entry"), ":")
    flat = by_entry.select("line_no", "pos", F.get(e, 0).alias("strategy_id"),
                           F.get(e, 1).cast("double").alias("multiplier"),
                           F.get(e, 2).cast("double").alias("baseline"),
                           F.explode("dims").alias("d"))
    return flat.select("line_no", "pos", "strategy_id", "d.dimension", "d.value",
                       "multiplier", "baseline")


def merged_multipliers(parsed: DataFrame) -> DataFrame:
    """Per (strategy, dimension, value) the last entry in file order wins."""
    return parsed.groupBy("strategy_id", "dimension", "value").agg(
        F.max_by("multiplier", F.struct("line_no", "pos")).alias("multiplier"))


def merged_baselines(parsed: DataFrame) -> DataFrame:
    """Per strategy, the first line that names it; inside it the last entry."""
    # a line entry repeats once per dimension column; repeats carry one value
    return parsed.groupBy("strategy_id").agg(
        F.min_by("baseline", F.struct("line_no", (-F.col("pos")).alias("neg_pos")))
        .alias("baseline"))


def read_price_file(spark: SparkSession, path: str, header_path: str) -> DataFrame:
    arr, dims = header_layout(spark, header_path)
    return parse_price_lines(read_lines(spark, path), arr, dims)
