"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Candidates of every kind are found with their places. Their values are hashed, and a table of the corpus counts the
distinct repositories and owners of each hash. A value that several owners hold is a copied example; one that a single
owner holds looks like a live credential of that owner. The base kinds are always reported; the wider kinds (bare mixed
tokens, other key names) are noisy, so the method adds their spans only where the value has one owner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.llm.common import let, materialize, spare

#: The base patterns, in the order in which kinds are listed. Letters of the first in either case.
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A run that is long enough is found at the same places as a run that is filtered afterwards.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
BASE_KINDS = ("assign", "access", "hex")
#: Wider kinds of the method: values of other key names, and bare tokens that mix cases and digits.
KEYED = r"""(?:[Pp]wd|PWD|[Cc]redentials?|[Pp]assphrase|[Bb]earer|[Aa]uthorization|[Pp]rivate_?[Kk]ey)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{12,})"""
BARE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[a-z0-9+/_=-]*[A-Z])(?=[A-Z0-9+/_=-]*[a-z])[A-Za-z0-9+/_=-]{20,}"
ADDED_KINDS = ("keyed", "bare")
KINDS = BASE_KINDS + ADDED_KINDS
#: Owners from which a value counts as widely copied.
EXAMPLE_OWNERS = 2
SPAN = "array<struct<start: bigint, end: bigint, rank: int, value: string>>"


def spans(text: Column, pattern: str, rank: int, group: int, least: int, gate: str | None = None) -> Column:
    """Leftmost, non-overlapping matches of a pattern whose group has at least `least` characters: start, end, rank, value.

    Places are code points: lengths of what the pattern leaves over and of what it matches, added up. Texts without a
    match of the gate (by default the pattern) stop there.
    """

    def of(parts: Column) -> Column:
        held = F.transform(parts["all"], lambda m, i: F.struct(F.length(F.get(parts["gaps"], i)).alias("gap"), F.length(m).alias("n"), F.get(parts["values"], i).alias("value")))
        start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(SPAN).alias("found"))

        def step(state: Column, m: Column) -> Column:
            begin = state["at"] + m["gap"]
            one = F.struct(begin.alias("start"), (begin + m["n"]).alias("end"), F.lit(rank).alias("rank"), m["value"].alias("value"))
            more = F.when(F.length(m["value"]) >= least, F.concat(state["found"], F.array(one).cast(SPAN))).otherwise(state["found"])
            return F.struct((begin + m["n"]).cast("bigint").alias("at"), more.alias("found"))

        return F.aggregate(held, start, step, lambda state: state["found"])

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    parts = F.struct(found.alias("all"), values.alias("values"), F.split(text, pattern, -1).alias("gaps"))
    return F.when(text.rlike(gate or pattern), let(parts, of)).otherwise(F.array().cast(SPAN))


def candidates(text: Column) -> Column:
    """All candidates of a text (null: empty), by start and then kind."""
    body = F.coalesce(text, F.lit(""))
    every = F.concat(
        spans(body, ASSIGN, 0, 2, 12),
        spans(body, ACCESS, 1, 0, 18),
        spans(body, HEX, 2, 0, 16),
        spans(body, KEYED, 3, 1, 12),
        spans(body, BARE, 4, 0, 20),
    )
    return F.array_sort(every)


def kind(rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(k) for k in KINDS]), rank + 1)


def listed(found: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", kind(s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def ownership(found: DataFrame) -> DataFrame:
    """Per value hash: n_repos and n_owners, capped nowhere. found: value_hash, repo, owner.

    Distinct triples are made before the shuffle, so a value that a third of all documents hold costs one row per task.
    """
    once = found.select("value_hash", "repo", "owner").distinct()
    return once.groupBy("value_hash").agg(F.countDistinct("repo").alias("n_repos"), F.countDistinct("owner").alias("n_owners"))


def scan(docs: DataFrame, repo: Column, owner: Column) -> DataFrame:
    """One row per document: doc_id, found (all reported spans with value_hash, n_repos, n_owners and example), base spans first.

    A document without candidates has an empty list. A null repo or owner is one of its own ("?"). Repeated rows stay:
    rows are told apart by their number in a written table, which is the same in every attempt.
    """
    small = docs.select("doc_id", F.coalesce(repo.cast("string"), F.lit("?")).alias("repo"), F.coalesce(owner.cast("string"), F.lit("?")).alias("owner"), candidates(F.col("text")).alias("c"))
    hashed = small.withColumn("c", F.transform("c", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["rank"].alias("rank"), F.sha2(s["value"], 256).alias("value_hash"))))
    rows = materialize(hashed, "secret-candidates").withColumn("row", F.monotonically_increasing_id())
    rows = materialize(rows, "secret-rows")
    each = rows.where(F.size("c") > 0).select("row", "repo", "owner", F.explode("c").alias("s")).select("row", "repo", "owner", "s.*")
    owned = materialize(ownership(each), "secret-owners")
    judged = each.join(owned, "value_hash").withColumn("example", F.col("n_owners") >= EXAMPLE_OWNERS)
    judged = judged.where((F.col("rank") < len(BASE_KINDS)) | ~F.col("example"))
    span = F.struct("start", F.col("rank"), "end", "value_hash", "n_repos", "n_owners", "example")
    gathered = judged.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("found"))
    empty = F.array().cast(gathered.schema["found"].dataType)
    return rows.select("row", "doc_id").join(gathered, "row", "left").select("doc_id", F.coalesce("found", empty).alias("found"))


def digest(scanned: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_owned (values of one owner) and n_examples."""
    base = F.filter("found", lambda s: s["rank"] < len(BASE_KINDS))
    number = lambda test: F.size(F.filter("found", test)).cast("bigint")
    of_kind = lambda r: number(lambda s: s["rank"] == r)
    return scanned.select(
        "doc_id",
        *[of_kind(r).alias(f"n_{name}") for r, name in enumerate(BASE_KINDS)],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
        number(lambda s: ~s["example"]).alias("n_owned"),
        number(lambda s: s["example"]).alias("n_examples"),
    )


def redact(docs: DataFrame, repo: Column, owner: Column) -> DataFrame:
    """docs with every reported span replaced by a mark: <EXAMPLE_KEY> for widely copied values, else <SECRET>.

    Overlapping spans are replaced as one, marked as an example only if all of them are. Documents without candidates,
    null texts and other columns stay as they are; n_chars follows the text where it is a column. Spans of the wider
    kinds whose value has several owners are left alone. Texts without candidates are not shuffled.
    """
    taken = list(docs.columns)
    key, mark, cover = spare("secret_id", taken), spare("secret_hash", taken), spare("secret_spans", taken)
    body = F.coalesce(F.col("text"), F.lit(""))
    holds = body.rlike(ASSIGN) | body.rlike(ACCESS) | body.rlike(HEX) | body.rlike(KEYED) | body.rlike(BARE)
    rows = docs.where(holds).withColumns({key: F.coalesce(F.col("doc_id").cast("string"), F.lit("")), mark: F.xxhash64("text")})
    each = rows.select(
        key,
        mark,
        F.coalesce(repo.cast("string"), F.lit("?")).alias("repo"),
        F.coalesce(owner.cast("string"), F.lit("?")).alias("owner"),
        F.explode(candidates(F.col("text"))).alias("s"),
    )
    each = materialize(each.select(key, mark, "repo", "owner", "s.start", "s.end", "s.rank", F.sha2("s.value", 256).alias("value_hash")), "secret-values")
    owned = materialize(ownership(each), "secret-owners")
    judged = each.join(owned, "value_hash").withColumn("example", F.col("n_owners") >= EXAMPLE_OWNERS)
    judged = judged.where((F.col("rank") < len(BASE_KINDS)) | ~F.col("example"))
    found = judged.groupBy(key, mark).agg(F.array_sort(F.collect_set(F.struct("start", "end", "example"))).alias(cover))
    found = materialize(found, "secret-spans")
    changed = rows.join(found, [key, mark], "left").withColumn("text", F.when(F.col(cover).isNull(), F.col("text")).otherwise(let(F.col(cover), lambda s: replaced(F.col("text"), s))))
    if "n_chars" in taken:
        changed = changed.withColumn("n_chars", F.when(F.col(cover).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return docs.where(~holds).unionByName(changed.select(*taken))


def replaced(text: Column, found: Column) -> Column:
    """text with the spans (sorted by start) replaced; runs of overlapping spans are merged first."""
    run = "array<struct<start: bigint, end: bigint, example: boolean>>"

    def merge(runs: Column, s: Column) -> Column:
        last = F.try_element_at(runs, F.lit(-1))
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), (last["example"] & s["example"]).alias("example"))
        grown = F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(joined).cast(run))
        return F.when((F.size(runs) > 0) & (F.try_element_at(runs, F.lit(-1))["end"] > s["start"]), grown).otherwise(F.concat(runs, F.array(s).cast(run)))

    def cut(runs: Column) -> Column:
        def part(r: Column, i: Column) -> Column:
            begin = F.when(i == 0, F.lit(0).cast("bigint")).otherwise(F.get(runs, i - 1)["end"])
            before = F.substring(text, (begin + 1).cast("int"), (r["start"] - begin).cast("int"))
            return F.concat(before, F.when(r["example"], F.lit("<EXAMPLE_KEY>")).otherwise(F.lit("<SECRET>")))

        tail = F.substring(text, (F.element_at(runs, -1)["end"] + 1).cast("int"), F.length(text))
        return F.concat(F.array_join(F.transform(runs, part), ""), tail)

    merged = F.aggregate(found, F.array().cast(run), lambda runs, s: merge(runs, s))
    return let(merged, lambda runs: F.when(F.size(runs) == 0, text).otherwise(cut(runs)))
