"""OCR provider responses (JSON) as text blocks and warnings."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.functions import text as X

# Response fields that are read. Numbers come as text, so that wrong types turn into null.
BLOCK_FIELDS = (
    "id string, type string, text string, content string, page string, original_page string, bbox array<string>, "
    "confidence string, parse_confidence string, confidence_score string, score string, ocr string"
)
RESPONSE = (
    "job_id string, duration string, page_count string, usage struct<num_pages string>, "
    f"result struct<type string, chunks array<struct<{BLOCK_FIELDS}, blocks array<struct<{BLOCK_FIELDS}>>>>>"
)
LOW_CONFIDENCE = 0.75
LABELS = {"high": 1.0, "medium": 0.75, "low": 0.0}
MESSAGES = {
    "ocr_empty": "OCR returned no text for a scanned page region.",
    "ocr_low_confidence": "OCR confidence is below the review threshold.",
}


def number(col: Column) -> Column:
    return col.try_cast("double")


def whole(col: Column) -> Column:
    return F.coalesce(col.try_cast("int"), F.floor(col.try_cast("double")).cast("int"))


def confidence(block: Column) -> Column:
    """Confidence as a number: the numeric keys first, then the label."""
    label = F.lower(block["confidence"])
    labelled = F.lit(None).cast("double")
    for name, value in LABELS.items():
        labelled = F.when(label == name, F.lit(value)).otherwise(labelled)
    numeric = [number(block[key]) for key in ("parse_confidence", "confidence_score", "score", "confidence")]
    return F.coalesce(*numeric, labelled)


def is_low(block: Column, value: Column) -> Column:
    return F.coalesce(F.lower(block["confidence"]) == "low", F.lit(False)) | F.coalesce(value < LOW_CONFIDENCE, F.lit(False))


def response_blocks(responses: DataFrame) -> DataFrame:
    """Blocks of responses given slug and json, in response order, with the warnings each block raises.

    A chunk without blocks but with content stands for its own block.
    """
    parsed = responses.select("slug", F.from_json("json", RESPONSE).alias("r"))
    names = [f.split()[0] for f in BLOCK_FIELDS.split(", ")]
    as_block = lambda c: F.struct(*[c[n].alias(n) for n in names])
    own = lambda c: F.when(
        (F.coalesce(F.size(c["blocks"]), F.lit(0)) <= 0) & (F.coalesce(c["content"], F.lit("")) != ""), F.array(as_block(c))
    ).otherwise(c["blocks"])
    chunks = parsed.select("slug", F.posexplode("r.result.chunks").alias("chunk_no", "c"))
    blocks = chunks.select("slug", "chunk_no", F.posexplode(own(F.col("c"))).alias("block_no", "b"))
    text = F.coalesce(F.nullif(F.col("b.text"), F.lit("")), F.col("b.content"), F.lit(""))
    page = whole(F.col("b.page"))
    box = F.transform("b.bbox", number)
    fallback = F.concat(
        F.col("slug"), F.lit("-p"), F.coalesce(F.nullif(page, F.lit(0)).cast("string"), F.lit("unknown")),
        F.lit("-c"), F.col("chunk_no") + 1, F.lit("-b"), F.col("block_no") + 1,
    )
    value = confidence(F.col("b"))
    rows = blocks.select(
        "slug",
        (F.col("chunk_no").cast("bigint") * 1000000 + F.col("block_no")).alias("block_ord"),
        F.coalesce(F.nullif(F.col("b.id"), F.lit("")), fallback).alias("block_id"),
        F.coalesce(F.nullif(F.col("b.type"), F.lit("")), F.lit("text")).alias("block_type"),
        text.alias("text"),
        page.alias("page"),
        F.coalesce(whole(F.col("b.original_page")), page).alias("original_page"),
        F.when(~F.exists(box, lambda x: x.isNull()), box).alias("bbox"),
        value.alias("confidence"),
        F.col("b.ocr").alias("ocr"),
        is_low(F.col("b"), value).alias("_low"),
    )
    raised = F.array_compact(
        F.array(F.when(X.strip(F.col("text")) == "", F.lit("ocr_empty")), F.when(F.col("_low"), F.lit("ocr_low_confidence")))
    )
    return rows.withColumn("warnings", raised).drop("_low")


def block_warnings(blocks: DataFrame) -> DataFrame:
    """One row per warning, in block order."""
    message = F.lit(None).cast("string")
    for category, text in MESSAGES.items():
        message = F.when(F.col("category") == category, F.lit(text)).otherwise(message)
    return blocks.select(
        "slug", "block_ord", "page", "original_page", "bbox", "confidence", F.posexplode("warnings").alias("ord", "category")
    ).select("*", F.lit("warning").alias("severity"), message.alias("message"))


def response_headers(responses: DataFrame, blocks: DataFrame) -> DataFrame:
    """Job data per response and its status: review is required as soon as a block raises a warning."""
    parsed = responses.select("slug", F.from_json("json", RESPONSE).alias("r"))
    count = blocks.groupBy("slug").agg(F.sum(F.size("warnings")).alias("warning_count"))
    return parsed.join(count, "slug", "left").select(
        "slug",
        F.col("r.job_id").alias("job_id"),
        whole(F.coalesce("r.usage.num_pages", "r.page_count")).alias("page_count"),
        number(F.col("r.duration")).alias("duration"),
        F.col("r.result.type").alias("result_type"),
        F.coalesce("warning_count", F.lit(0)).alias("warning_count"),
        F.when(F.coalesce("warning_count", F.lit(0)) > 0, "review_required").otherwise("ok").alias("status"),
    )


def extract_responses(documents: DataFrame, responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Blocks of the answers (slug, json) to documents (slug), and per document everything that is to be reported.

    The second table has a row for every document that raises something: slug, page_count and w, an ordered array of
    block_ord, ord, category, severity and message. A missing answer, one that is no JSON of the known form, and several
    answers for one document are errors of that document; an answer without any text is one as well.
    """
    given = responses.groupBy("slug").agg(F.count("*").alias("n"), F.min("json").alias("json"))
    held = documents.select("slug").join(given, "slug", "left").withColumn("chunks", F.from_json("json", RESPONSE)["result"]["chunks"])
    wrong = (
        F.when(F.col("json").isNull(), F.lit("No OCR answer was found."))
        .when(F.col("n") > 1, F.lit("Several OCR answers were found."))
        .when(F.col("chunks").isNull(), F.lit("The OCR answer could not be read."))
    )
    held = held.withColumn("wrong", wrong)
    readable = held.where(F.col("wrong").isNull()).select("slug", "json")
    blocks = response_blocks(readable)
    headers = response_headers(readable, blocks).select("slug", "page_count")
    texts = blocks.where(X.strip(F.col("text")) != "").select("slug").distinct().withColumn("has_text", F.lit(True))
    name = F.when(F.col("json").isNotNull(), F.lit("ValidationError"))
    failed = held.where(F.col("wrong").isNotNull()).select("slug", error_category(F.lit(None).cast("int"), name, F.lit("")).alias("category"), F.col("wrong").alias("message"))
    empty = readable.join(texts, "slug", "left_anti").select("slug", F.lit("partial_extraction").alias("category"), F.lit("The OCR answer holds no text.").alias("message"))
    errors = failed.unionByName(empty).select("slug", F.lit(-1).cast("bigint").alias("block_ord"), F.lit(0).alias("ord"), "category", F.lit("error").alias("severity"), "message")
    raised = errors.unionByName(block_warnings(blocks).select("slug", "block_ord", "ord", "category", "severity", "message"))
    warned = raised.groupBy("slug").agg(F.sort_array(F.collect_list(F.struct("block_ord", "ord", "category", "severity", "message"))).alias("w"))
    return blocks.join(headers, "slug", "left"), warned


def error_category(status: Column, name: Column, message: Column) -> Column:
    """Warning category of a provider failure from its status code, exception name and message; first rule wins."""
    name, message = F.lower(F.coalesce(name, F.lit(""))), F.lower(F.coalesce(message, F.lit("")))
    has = F.contains
    code = lambda *values: F.coalesce(status.isin(*values), F.lit(False))
    return (
        F.when(code(401, 403) | has(name, F.lit("auth")) | has(name, F.lit("permission")), "provider_auth")
        .when(code(429) | has(name, F.lit("ratelimit")) | has(message, F.lit("rate limit")), "provider_rate_limit")
        .when(code(408, 504) | has(name, F.lit("timeout")) | has(message, F.lit("timed out")), "provider_timeout")
        .when(code(442) | has(message, F.lit("password")), "pdf_password_protected")
        .when(code(413, 415) | has(message, F.lit("corrupt")) | has(message, F.lit("unsupported")), "pdf_corrupt_or_unsupported")
        .when(has(name, F.lit("connection")), "provider_connection")
        .when(code(422) | has(name, F.lit("validation")), "provider_validation")
        .when(F.coalesce(status, F.lit(0)) != 0, "provider_api_error")
        .otherwise("unknown_provider_error")
    )


def failed_extractions(failures: DataFrame) -> DataFrame:
    """Extraction rows of failed provider calls: slug, status_code, error_name, error_message."""
    category = error_category(F.col("status_code"), F.col("error_name"), F.col("error_message"))
    return failures.select(
        "slug",
        F.lit("failed").alias("status"),
        category.alias("category"),
        F.lit("error").alias("severity"),
        F.concat(F.lit("OCR extraction failed with category "), category, F.lit(".")).alias("message"),
        F.col("status_code").cast("string").alias("provider_code"),
    )
