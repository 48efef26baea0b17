"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierweave.llm.common import let, staged

_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
#: Fixed patterns of the base kinds, in their order; a match counts if the value (group 1) has so many characters.
BASE = {
    "assign": (_ASSIGN + r"([A-Za-z0-9+/_.=-]+)", 6),
    "access": (r"(AKIA[A-Z0-9]+)", 20),
    "hex": (r"([0-9a-f]{24,})", 24),
}
#: Kinds of which only values that look live are reported: web tokens, and keys with a vendor's prefix.
ADDED = {
    "jwt": (r"(eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})", 28),
    "vendor": (r"((?:ghp_|gho_|ghs_|glpat-|xoxb-|xoxp-|sk_live_|AIza)[A-Za-z0-9_-]{16,})", 20),
}
KINDS = BASE | ADDED
#: A value that so many owners have is an example that was copied, not somebody's credential.
WIDE_OWNERS = 3
#: Marks matches while a text is split; texts that hold it get its neighbour, which no pattern matches either.
_MARK, _OTHER = "\uffff", "\ufffe"


def _found(text: Column) -> Column:
    return F.rlike(text, F.lit("|".join(p for p, _ in KINDS.values())))


def _parts(text: Column, pattern: str) -> Column:
    """The text cut at its matches: lengths in code points, and the match itself at odd places."""
    cut = F.split(F.regexp_replace(text, f"(?:{pattern})", f"{_MARK}$0{_MARK}"), _MARK, -1)
    return F.transform(cut, lambda p, i: F.struct(F.char_length(p).alias("chars"), F.when(i % 2 == 1, p).alias("hit")))


def _looks_live(value: Column) -> Column:
    """Digits and letters mixed, at least eight different characters, no word that marks a placeholder."""
    variety = F.size(F.array_distinct(F.split(value, "")))
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (variety >= 8) & ~F.lower(value).rlike("example|changeme|your|xxxx|dummy")


def candidates(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repository_cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, hits): rows has one row per document with a row number and whether anything was found in it; hits one per match."""
    text = F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit(_MARK), F.lit(_OTHER))
    cuts = lambda t: F.array(*(F.struct(F.lit(k).alias("kind"), F.lit(i).alias("nth"), _parts(t, p).alias("parts")) for i, (k, (p, _)) in enumerate(KINDS.items())))
    rows = staged(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(owner_col).cast("string").alias("owner"),
            F.to_json(F.struct(*(F.col(c).alias(f"c{i}") for i, c in enumerate(repository_cols)))).alias("repository"),
            F.xxhash64(F.col(text_col)).alias("text_hash"),
            let(text, lambda t: F.when(_found(t), cuts(t))).alias("cuts"),
        ).withColumn("row", F.monotonically_increasing_id())
    )
    parts = (
        rows.where("cuts IS NOT NULL")
        .select("row", "owner", "repository", F.explode("cuts").alias("cut"))
        .where(F.size("cut.parts") > 1)
        .select("row", "owner", "repository", "cut.kind", "cut.nth", F.posexplode("cut.parts").alias("place", "part"))
    )
    before = Window.partitionBy("row", "nth").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    hits = parts.select("*", F.coalesce(F.sum("part.chars").over(before), F.lit(0)).alias("start")).where("part.hit IS NOT NULL")
    # Greedy values: what stands behind the key word of an assignment, the whole match otherwise.
    value = F.when(F.col("kind") == "assign", F.regexp_extract("part.hit", BASE["assign"][0], 1)).otherwise(F.col("part.hit"))
    least = reduce(lambda e, k: e.when(F.col("kind") == k, KINDS[k][1]), KINDS, F)
    hits = hits.select("row", "owner", "repository", "kind", "nth", "start", (F.col("start") + F.col("part.chars")).alias("end"), value.alias("value"))
    return rows, hits.where(F.char_length("value") >= least)


def ownership(hits: DataFrame, wide_owners: int = WIDE_OWNERS) -> DataFrame:
    """Per value hash: n_owners, n_repositories, n_hits, and whether owners enough have it to call it widely copied.

    Combines rows before each shuffle, so a value that a third of all rows hold costs its owners, not its rows.
    A null owner is one owner of its own, and so is a null repository.
    """
    by_repository = hits.groupBy("hash", "owner", "repository").agg(F.count(F.lit(1)).alias("hits"))
    by_owner = by_repository.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repositories"), F.sum("hits").alias("hits"))
    return by_owner.groupBy("hash").agg(
        F.count(F.lit(1)).alias("n_owners"),
        F.sum("repositories").alias("n_repositories"),
        F.sum("hits").alias("n_hits"),
    ).withColumn("wide", F.col("n_owners") >= wide_owners)


def scan_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repository_cols: tuple[str, ...] = ("source", "lang"),
    wide_owners: int = WIDE_OWNERS,
) -> DataFrame:
    """Per row of docs: doc_id, n_assign, n_access, n_hex, base (base spans), spans (all spans), own_spans (those of
    values that are not widely copied), n_live, n_copied, text_hash (of the text that was scanned).

    Spans are arrays of (start, nth, kind, end), in code points, by start and then kind. All base matches stay,
    whoever owns them. A match of an added kind is a span if its value looks live and is not widely copied.
    n_live counts spans whose value looks live and is owner-specific, n_copied those that many owners share.

    Matches are leftmost and do not overlap within a kind. Null text counts as empty. Repeated rows are scanned
    one by one and come back one by one; the same id twice counts as two hits of one owner. Null owners count as one owner. An
    empty table gives an empty result; columns that are not named are never read.
    """
    rows, hits = candidates(docs, id_col, text_col, owner_col, list(repository_cols))
    hits = staged(hits.withColumn("hash", F.sha2("value", 256)).withColumn("looks", _looks_live(F.col("value"))).drop("value"))
    judged = hits.join(ownership(hits, wide_owners).select("hash", "wide"), "hash")
    judged = judged.withColumn("live", F.col("looks") & ~F.col("wide"))
    base = F.col("kind").isin(*BASE)
    span = F.struct("start", "nth", "kind", "end")
    count = lambda c: F.count(F.when(c, 1))
    found = (
        judged.where(base | F.col("live"))
        .groupBy("row")
        .agg(
            *(count(F.col("kind") == k).alias(f"n_{k}") for k in BASE),
            F.array_sort(F.collect_list(F.when(base, span))).alias("base"),
            F.array_sort(F.collect_list(span)).alias("spans"),
            F.array_sort(F.collect_list(F.when(~F.col("wide"), span))).alias("own_spans"),
            count(F.col("live")).alias("n_live"),
            count(F.col("wide")).alias("n_copied"),
        )
    )
    some, none = rows.where("cuts IS NOT NULL").select("id", "row", "text_hash"), rows.where("cuts IS NULL").select("id", "text_hash")
    numbers = [*(f"n_{k}" for k in BASE), "n_live", "n_copied"]
    arrays = ("base", "spans", "own_spans")
    empty = "array<struct<start:bigint,nth:int,kind:string,end:bigint>>"
    with_hits = some.join(found, "row", "left").select(
        "id", *(F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in numbers),
        *(F.coalesce(F.col(s).cast(empty), F.array().cast(empty)).alias(s) for s in arrays),
        "text_hash",
    )
    without = none.select("id", *(F.lit(0).cast("long").alias(n) for n in numbers), *(F.array().cast(empty).alias(s) for s in arrays), "text_hash")
    return with_hits.unionByName(without).withColumnRenamed("id", "doc_id")


def spelled(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with each span's characters replaced by one mark; overlapping spans are joined."""
    merged = F.aggregate(
        spans,
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out")),
        lambda a, s: F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(s["start"] >= a["at"], F.concat(a["out"], F.array(F.substr(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit("[secret]")))).otherwise(a["out"]).alias("out"),
        ),
    )
    done = let(merged, lambda m: F.concat(F.array_join(m["out"], ""), F.substr(text, (m["at"] + 1).cast("int"))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


#: The same digests in DuckDB: matches are marked, the text is cut there, and the lengths are summed.
def sql() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    kinds = " UNION ALL ".join(
        f"SELECT doc_id, owner, repository, '{k}' AS kind, {i} AS nth, {least} AS least, {'true' if k in BASE else 'false'} AS base, "
        f"string_split(regexp_replace(body, {quoted('(' + p + ')')}, chr(65535) || '\\1' || chr(65535), 'g'), chr(65535)) AS parts FROM d"
        for i, (k, (p, least)) in enumerate(KINDS.items())
    )
    return f"""
WITH d AS (
  SELECT doc_id, source AS owner, concat(source, '/', lang) AS repository,
    replace(coalesce(text, ''), chr(65535), chr(65534)) AS body FROM documents
), cut AS (
  SELECT *, unnest(generate_series(1, len(parts) // 2)) AS k FROM ({kinds}) WHERE len(parts) > 1
), hit AS (
  SELECT doc_id, owner, repository, kind, nth, least, base, parts[2 * k] AS hit,
    list_sum(list_transform(parts[1 : 2 * k - 1], lambda x: length(x)))::BIGINT AS s FROM cut
), val AS (
  SELECT *, s + length(hit) AS e,
    CASE WHEN kind = 'assign' THEN regexp_extract(hit, {quoted(BASE['assign'][0])}, 1) ELSE hit END AS v FROM hit
), ok AS (
  SELECT *, regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') AND len(list_distinct(string_split(v, ''))) >= 8
      AND NOT regexp_matches(lower(v), 'example|changeme|your|xxxx|dummy') AS looks
  FROM val WHERE length(v) >= least
), own AS (
  SELECT v, count(DISTINCT owner) >= {WIDE_OWNERS} AS wide FROM ok GROUP BY v
), judged AS (
  SELECT ok.*, own.wide, looks AND NOT own.wide AS live FROM ok JOIN own ON ok.v = own.v
), per AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (live) AS n_live, count(*) FILTER (wide) AS n_copied,
    string_agg(concat(kind, ':', s, ':', e), ',' ORDER BY s, nth) FILTER (base) AS base,
    string_agg(concat(kind, ':', s, ':', e), ',' ORDER BY s, nth) AS spans
  FROM judged WHERE base OR live GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM d LEFT JOIN per ON d.doc_id = per.doc_id
"""
