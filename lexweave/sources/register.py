"""Warning registers in the forms they come in: JSON rows, one JSON document, or a Markdown table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.functions import text as X

# The names a register may have for its columns and for its list of rows.
CLAUSE_NAMES = ("affected_clause", "affected_clause_id", "clause_id", "source_clause")
WARNING_NAMES = ("warning_id", "id")
LIST_NAMES = ("warnings", "items")
LINKS = "card_id string, warning_id string"


def json_links(texts: DataFrame) -> DataFrame:
    """card_id and warning_id from a column `value` of JSON texts: objects, lists of them, or objects that hold such a list.

    The first name with a value that is not empty counts, row by row. Rows without a clause or a warning are left out, and
    so is what is no JSON.
    """
    rows = F.from_json("value", "array<variant>")
    held = F.coalesce(*[F.from_json(F.get_json_object("value", f"$.{name}"), "array<variant>") for name in LIST_NAMES])
    one = F.when(F.ltrim("value").startswith("{"), F.array(F.try_parse_json("value")))
    listed = F.when(F.ltrim("value").startswith("["), rows).otherwise(F.coalesce(held, one))
    item = texts.select(F.explode(listed).alias("v"))
    first = lambda names: F.coalesce(*[X.present(F.try_variant_get("v", f"$.{name}", "string")) for name in names])
    return item.select(first(CLAUSE_NAMES).alias("card_id"), first(WARNING_NAMES).alias("warning_id")).dropna()


def table_links(lines: DataFrame) -> DataFrame:
    """card_id and warning_id from lines of a Markdown table: the first cell is the warning, the second the clause.

    The line of column names and the rule below it are no rows, nor is a line with an empty cell among the two.
    """
    cells = F.split(F.regexp_replace(F.trim("value"), r"^\||\|$", ""), r"\|")
    rows = lines.where(F.ltrim("value").startswith("|") & (F.size(cells) >= 2)).select(F.transform(cells, X.strip).alias("c"))
    head = F.col("c")[0].rlike(r"^:?-+:?$") | F.lower(F.regexp_replace(F.col("c")[0], r"[ _-]+", "_")).isin("warning", *WARNING_NAMES)
    return rows.where(~head).select(X.present(F.col("c")[1]).alias("card_id"), X.present(F.col("c")[0]).alias("warning_id")).dropna()


def _texts(spark: SparkSession, path: str, whole: bool) -> DataFrame | None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return None
    return spark.read.text(path, wholetext=whole)


def read_register(spark: SparkSession, path: str) -> DataFrame:
    """Links card_id, warning_id of the register at path, a file or folder ending in .json or .md, or their common name.

    JSON comes first; where it is missing or gives no link, the Markdown table beside it is read. JSON files that are one
    document are read whole, rows of JSON line by line. Without either there are no links.
    """
    path = path.rstrip("/")
    base = path.rsplit(".", 1)[0] if path.endswith((".json", ".md")) else path
    for name in dict.fromkeys((f"{base}.json", path)):
        lines = None if name.endswith(".md") else _texts(spark, name, whole=False)
        if lines is None:
            continue
        opens = lines.where("trim(value) <> ''").select(F.trim("value").alias("value")).first()
        rows = opens is not None and opens.value.startswith("{") and opens.value.endswith("}")
        links = json_links(lines if rows else _texts(spark, name, whole=True))
        if not links.isEmpty():
            return links
    table = _texts(spark, f"{base}.md", whole=False)
    return spark.createDataFrame([], LINKS) if table is None else table_links(table)
