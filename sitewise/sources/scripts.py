r"""Seed scripts as a source: rows from literal ``INSERT INTO t (columns) VALUES (values);`` statements.

Files are cut at semicolons wherever they lie, so that large scripts are read by many tasks; a piece that ends
inside a text literal goes on in the next one. A statement begins at a piece that begins with ``INSERT INTO`` and ends
at the first semicolon outside a literal, so an unclosed quote spoils its own statement and no other.
All other statements are passed over. Values: numbers, ``NULL``, text in quotes with quotes doubled,
``TO_DATE('text', 'pattern')`` and ``sequence.NEXTVAL``. Lines that begin with ``--`` are comments; they hold no semicolon.

What is no such statement, names an unknown column or has other than one value for each column is
reported with its text; so is a row whose values do not fit the columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitewise.functions.prefix import running_sums
from sitewise.session import settle
from sitewise.sources.ingest import seed_ingest
from sitewise.sources.sequences import number_load

_TEXT = r"'(?:[^']++|'')*+'"
_DATE = rf"TO_DATE\s*+\(\s*+{_TEXT}\s*+,\s*+{_TEXT}\s*+\)"
_VALUE = rf"(?:{_DATE}|{_TEXT}|[A-Za-z_][A-Za-z0-9_$]*+\.NEXTVAL|NULL|[-+]?[0-9]++(?:\.[0-9]++)?)"
_HEAD = r"(?is)^\s*+insert\s++into\s++(?:[a-z0-9_$]++\.)?([a-z0-9_$]++)\s*+\(([^()]*+)\)\s*+values\s*+\((.*)\)\s*+$"
_LIST = rf"(?is)^\s*+{_VALUE}(?:\s*+,\s*+{_VALUE})*+\s*+$"
# Date patterns, longest first: as the scripts write them, and as Spark does.
_PATTERNS = [("HH24", "HH"), ("YYYY", "yyyy"), ("MI", "mm"), ("SS", "ss"), ("DD", "dd")]
DAY = "yyyy-MM-dd HH:mm:ss"
# A file of more pieces is cut into ranges: what a task sorts does not grow with the files.
FILE_PIECES = 100_000


def statements(spark: SparkSession, path: str) -> DataFrame:
    """``file, position, statement`` of every insert statement, without its semicolon."""
    pieces = spark.read.option("lineSep", ";").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("piece")).alias("position"),
        F.regexp_replace("value", r"(?m)^[ \t]*+--.*$", "").alias("text"),
    )
    pieces = settle(
        pieces.withColumns(
            {
                "starts": F.col("text").rlike(r"(?i)^\s*+insert\s++into\s").cast("bigint"),
                "quotes": (F.char_length("text") - F.char_length(F.replace("text", F.lit("'")))).cast("bigint"),
            }
        )
    )
    numbered = settle(running_sums(pieces, ["file"], ["position"], {"number": "starts"}, FILE_PIECES).where("number > 0"))
    upto = running_sums(numbered, ["file", "number"], ["position"], {"upto": "quotes"})
    own = upto.where((F.col("starts") == 1) | ((F.col("upto") - F.col("quotes")) % 2 == 1))
    joined = own.groupBy("file", "number").agg(F.sort_array(F.collect_list(F.struct("position", "text"))).alias("pieces"))
    return joined.select(
        "file", F.col("pieces")[0]["position"].alias("position"), F.array_join(F.transform("pieces", lambda p: p["text"]), ";").alias("statement")
    )


def _unquoted(text: Column) -> Column:
    return F.replace(F.substring(text, F.lit(2), F.char_length(text) - 2), F.lit("''"), F.lit("'"))


def _plain(value: Column) -> Column:
    """The text of a value; a date in one pattern, or as written where it is none."""
    inside = F.regexp_extract_all(value, F.lit(f"({_TEXT})"), F.lit(1))
    pattern = F.upper(_unquoted(inside[1]))
    for theirs, ours in _PATTERNS:
        pattern = F.replace(pattern, F.lit(theirs), F.lit(ours))
    text = _unquoted(inside[0])
    day = F.date_format(F.try_to_timestamp(text, pattern), DAY)
    return (
        F.when(F.upper(value) == "NULL", F.lit(None).cast("string"))
        .when(value.rlike(r"(?i)^to_date"), F.coalesce(day, text))
        .when(F.startswith(value, F.lit("'")), _unquoted(value))
        .otherwise(value)
    )


def read_inserts(spark: SparkSession, path: str, table: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """``file, position, values`` (text by lower-case column) of the statements on a table, and
    ``file, position, statement, reason`` of what cannot be read."""
    known = F.array(*[F.lit(c.lower()) for c in columns])
    found = statements(spark, path).withColumns(
        {
            "table": F.lower(F.regexp_extract("statement", _HEAD, 1)),
            "names": F.transform(F.split(F.lower(F.regexp_extract("statement", _HEAD, 2)), ","), lambda c: F.trim(F.replace(F.replace(c, F.lit("\n"), F.lit(" ")), F.lit("\r"), F.lit(" ")))),
            "list": F.regexp_extract("statement", _HEAD, 3),
        }
    )
    found = found.withColumn("items", F.regexp_extract_all("list", F.lit(f"(?is)({_VALUE})"), F.lit(1)))
    reason = (
        F.when(F.col("table") == "", "no insert of literal values")
        .when(~F.col("list").rlike(_LIST), "a value that is no literal")
        .when(F.size(F.array_except("names", known)) > 0, "a column that is not known")
        .when(F.size("names") != F.size(F.array_distinct("names")), "a column named twice")
        .when(F.size("names") != F.size("items"), "not one value for each column")
    )
    judged = settle(found.where(F.col("table").isin("", table.lower())).withColumn("reason", reason))
    good = judged.where("reason IS NULL").select("file", "position", F.map_from_arrays("names", F.transform("items", lambda v: v)).alias("values"))
    return good, judged.where("reason IS NOT NULL").select("file", "position", "statement", "reason")


def load_script(
    spark: SparkSession, path: str, table: str, schema: T.StructType, sequences: str, load: str
) -> tuple[DataFrame, DataFrame]:
    """Typed rows of a table's statements, and what was refused: ``file, statement`` and ``reason``.

    A column whose values are ``<sequence>.NEXTVAL`` is numbered in the order of the statements from the
    sequence stored under ``sequences``; ``load`` names the load there. Only rows that are sound take keys.
    """
    rows, bad = read_inserts(spark, path, table, schema.names)
    ordered = ["file", "position"]
    texts = rows.select(
        *ordered, F.to_json("values").alias("statement"), *[_plain(F.col("values")[f.name.lower()]).alias(f.name) for f in schema.fields]
    )
    # What a NEXTVAL will be is not known yet: the row is judged without it.
    nextval = r"(?i)^[a-z_][a-z0-9_$]*\.nextval$"
    wanted = {f.name: F.when(F.col(f.name).rlike(nextval), F.lower(F.regexp_replace(f.name, r"(?i)\.nextval$", ""))) for f in schema.fields}
    marked = settle(texts.select("*", *[w.alias(f"_from_{name}") for name, w in wanted.items()]))
    clean = marked.select(
        *ordered, "statement", *[F.when(F.col(f"_from_{n}").isNull(), F.col(n)).alias(n) for n in schema.names], *[f"_from_{n}" for n in schema.names]
    )
    typed, faulty = seed_ingest(clean, schema, DAY, exact=True, carry=[*ordered, "statement", *[f"_from_{n}" for n in schema.names]])
    typed = settle(typed)
    for name in schema.names:
        used = [r[0] for r in typed.select(f"_from_{name}").distinct().collect() if r[0] is not None]  # one sequence a column, as a rule
        for sequence in used:
            own = typed.where(F.col(f"_from_{name}") == sequence).drop(name)
            keyed = number_load(own, sequences, sequence, load, ordered, name)
            rest = typed.where(~F.col(f"_from_{name}").eqNullSafe(sequence))
            typed = settle(rest.unionByName(keyed.withColumn(name, F.col(name).cast(schema[name].dataType))))
    refused = bad.select("file", "statement", "reason").unionByName(
        faulty.select("file", "statement", F.concat(F.lit("does not fit: "), F.col("bad_columns")).alias("reason"))
    )
    return typed.select(*schema.names), refused
