"""Secret scans with corpus-wide ownership frequency, in DataFrame expressions only.

Base patterns give spans in every text. A hash of each candidate value is then counted
over the corpus by distinct repositories and owners: a value of many owners is a widely
copied example, a value of one owner with mixed characters looks like a live credential.
The method also scans for bare mixed-character tokens and adds, as kind ``owned``, those
outside base spans that a single owner holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtext.llm.common import store

# The patterns that base spans must follow. Group 2 of a match is the
# value; the last number is its least length.
ASSIGN = (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
          r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = r"()(AKIA[A-Z0-9]+)"
HEX = r"()([0-9a-f]{16,})"
OWNED = r"()([A-Za-z0-9+/_-]{20,})"
KINDS = (("assign", ASSIGN, 12), ("access", ACCESS, 18), ("hex", HEX, 16), ("owned", OWNED, 20))
BASE = ("assign", "access", "hex")
COPIED_OWNERS = 3  # a value of this many owners or more is a widely copied example
FILTER_BITS = 1 << 23  # marks that tell which texts may hold a value to mask; 2^17 rows of 64 are broadcast at most


def _matches(text: Column, kind: int, pattern: str) -> Column:
    """Array of (kind, gap, head, value) for the leftmost non-overlapping matches: gap
    is the length of the text between the previous match and this one, head that of the
    match before its value. Matched only where a find says that there is one."""
    # groups: 1 gap, 2 match, 3 and 4 the pattern's own; the tail is one (dropped) match of
    # its own, else the search would start again at each of its characters
    whole = F.lit(rf"(?s)(.*?)(?:({pattern})|\z)")
    at = [F.regexp_extract_all(text, whole, F.lit(g)) for g in (1, 2, 4)]
    entry = F.transform(F.arrays_zip(*[a.alias(n) for a, n in zip(at, ("g", "m", "v"), strict=True)]), lambda x: F.struct(
        F.lit(kind).alias("kind"), F.length(x["g"]).cast("long").alias("gap"),
        F.length(x["m"]).cast("long").alias("size"), x["v"].alias("value")))
    none = F.array().cast("array<struct<kind:int,gap:bigint,size:bigint,value:string>>")
    return F.when(text.rlike(pattern), F.filter(entry, lambda x: x["size"] > 0)).otherwise(none)


def named_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo: Column | None = None,
               owner: Column | None = None) -> DataFrame:
    """(row, id, text, owner, repo, copy): row is the whole input row. copy is a hash of
    text, owner and repository, so rows that share an id (or have none) keep their own
    owners. A null repository or owner counts as one of its own."""
    owner = F.coalesce((F.col("source") if owner is None else owner).cast("string"), F.lit("\0null"))
    repo = F.coalesce((F.concat_ws("/", "source", "lang") if repo is None else repo).cast("string"), F.lit("\0null"))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), F.col(f"`{id_col}`").alias("id"), text.alias("text"), owner.alias("owner"), repo.alias("repo"))
    return rows.withColumn("copy", F.xxhash64("text", "owner", "repo"))


def find_spans(rows: DataFrame) -> DataFrame:
    """(id, copy, owner, repo, kind, start, end, value, value_hash) of :func:`named_rows`:
    every match that is long enough, in code points, end exclusive. Rows that agree in id,
    text, owner and repository count once."""
    text, named = F.col("text"), ["id", "copy", "owner", "repo"]
    some = rows.where(text.rlike("|".join(p for _, p, _ in KINDS)))
    hits = F.concat(*[_matches(text, i, p) for i, (_, p, _) in enumerate(KINDS)])
    found = some.select(*named, F.posexplode_outer(hits).alias("nth", "hit")).where("nth is not null") \
        .select(*named, "nth", "hit.*").dropDuplicates(["id", "copy", "nth"])
    run = Window.partitionBy("id", "copy", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("size")).over(run)
    least = F.element_at(F.array(*[F.lit(n) for _, _, n in KINDS]), F.col("kind") + 1)
    mixed = F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Z]") & F.col("value").rlike("[a-z]")
    spans = found.withColumn("end", end).withColumn("start", F.col("end") - F.col("size")) \
        .where(F.length("value") >= least).where((F.col("kind") < len(BASE)) | mixed)
    return spans.select(*named, "kind", "start", "end", "value", F.sha2("value", 256).alias("value_hash"))


def ownership(spans: DataFrame) -> DataFrame:
    """Per value_hash: n_repos, n_owners, copied (many owners), live (one owner and a
    value of mixed characters)."""
    # distinct (value, repository) rows first: a value in a third of all rows folds map-side
    pairs = spans.groupBy("value_hash", "owner", "repo").agg(F.first("value").alias("value"))
    mixed = F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]")
    per_owner = pairs.groupBy("value_hash", "owner").agg(F.count(F.lit(1)).alias("repos"), F.first("value").alias("value"))
    out = per_owner.groupBy("value_hash").agg(F.sum("repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"),
                                              F.bool_or(mixed).alias("mixed"))
    return out.select("value_hash", "n_repos", "n_owners", (F.col("n_owners") >= COPIED_OWNERS).alias("copied"),
                      ((F.col("n_owners") == 1) & F.col("mixed")).alias("live"))


def judged_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo: Column | None = None,
                 owner: Column | None = None) -> DataFrame:
    """All spans of the result with their value's ownership: base spans, and owned spans
    that lie outside every base span of their text and belong to one owner."""
    spans = store(find_spans(named_rows(docs, id_col, text_col, repo, owner)), "secret-spans")
    judged = spans.join(ownership(spans), "value_hash")
    base = F.col("kind") < len(BASE)
    # longest reach of the base spans that start at or before a span, and the first after it
    order = Window.partitionBy("id", "copy").orderBy("start", "kind")
    ends = F.max(F.when(base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    follows = F.min(F.when(base, F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    free = (F.coalesce(ends, F.lit(0)) <= F.col("start")) & (F.col("end") <= F.coalesce(follows, F.col("end")))
    return judged.withColumn("free", free).where(base | (F.col("free") & F.col("live"))).drop("free")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo: Column | None = None,
                 owner: Column | None = None) -> DataFrame:
    """One row per input row: id, n_assign, n_access, n_hex, base_sha256, spans, n_live,
    n_copied.

    Null and empty texts have no spans; texts of any length are scanned whole; a value's
    owners are those of the very rows that hold it, whatever ids they share; equal rows
    get the same result each; an empty table gives no rows; ties of start order by kind;
    other columns, whatever their names, are not read.
    """
    rows = named_rows(docs, id_col, text_col, repo, owner).select("id", "copy")
    judged = judged_spans(docs, id_col, text_col, repo, owner)
    name = F.element_at(F.array(*[F.lit(k) for k, _, _ in KINDS]), F.col("kind") + 1)
    shown = judged.withColumn("shown", F.concat_ws(":", name, "start", "end"))
    ordered = F.sort_array(F.collect_list(F.struct("start", "kind", "end", "shown")))
    counts = [F.count(F.when(F.col("kind") == i, 1)).alias(f"n_{k}") for i, k in enumerate(BASE)]
    per = shown.groupBy("id", "copy").agg(*counts, ordered.alias("all"), F.count(F.when(F.col("live"), 1)).alias("n_live"),
                                          F.count(F.when(F.col("copied"), 1)).alias("n_copied"))
    per = per.select(F.col("id").alias("_id"), F.col("copy").alias("_copy"), *[f"n_{k}" for k in BASE], "n_live", "n_copied",
                     F.array_join(F.transform(F.filter("all", lambda x: x["kind"] < len(BASE)), lambda x: x["shown"]), ",")
                     .alias("base"), F.array_join(F.transform("all", lambda x: x["shown"]), ",").alias("spans"))
    out = rows.join(per, F.col("id").eqNullSafe(F.col("_id")) & (F.col("copy") == F.col("_copy")), "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in (*[f"n_{k}" for k in BASE], "n_live", "n_copied")]
    return out.select(F.col("id").alias(id_col), *zero[:3], F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
                      F.coalesce("spans", F.lit("")).alias("spans"), *zero[3:])


def _marked(rows: DataFrame, found: DataFrame, bits: int) -> DataFrame:
    """``rows`` with ``may``: true for each whose copy is an of_copy of ``found``, and for
    some others, the more of them the more ``found`` has. Each copy is one of ``bits``
    marks; the marks, 64 to a row, are broadcast, so their size has a bound."""
    word = lambda c: F.shiftright(F.pmod(c, F.lit(bits)), 6)
    mark = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(c, F.lit(64)).cast("int"))
    marks = found.groupBy(word(F.col("of_copy")).alias("word")).agg(F.bit_or(mark(F.col("of_copy"))).alias("marks"))
    met = rows.join(F.broadcast(marks), word(F.col("copy")) == F.col("word"), "left")
    return met.withColumn("may", F.coalesce(F.col("marks").bitwiseAND(mark(F.col("copy"))) != 0, F.lit(False))).drop("word", "marks")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]",
           repo: Column | None = None, owner: Column | None = None, bits: int = FILTER_BITS) -> DataFrame:
    """``docs`` with every value that is not a widely copied example replaced by ``mark``
    in the texts it was found in. Texts without such values (null and empty ones among
    them), and all other columns, whatever their names, stay as they are; rows are never
    dropped; equal rows are masked alike; an empty table gives no rows."""
    judged = judged_spans(docs, id_col, text_col, repo, owner).where(~F.col("copied"))
    longest = F.sort_array(F.collect_set(F.struct((-F.length("value")).alias("n"), "value")))
    per = store(judged.groupBy(F.col("id").alias("of_id"), F.col("copy").alias("of_copy")).agg(longest.alias("values")), "secret-values")
    # only rows that may hold a value move to meet it
    rows = _marked(named_rows(docs, id_col, text_col, repo, owner).select("row", "id", "copy"), per, bits)
    met = rows.where("may").join(per, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("copy") == F.col("of_copy")), "left")
    text = F.coalesce(F.col("row").getField(text_col).cast("string"), F.lit(""))
    cleaned = F.aggregate("values", text, lambda t, v: F.replace(t, v["value"], F.lit(mark)))
    whole = F.when(F.col("values").isNull(), F.col("row")).otherwise(F.col("row").withField(f"`{text_col}`", cleaned))
    return rows.where("not may").select("row").union(met.select(whole.alias("row"))).select("row.*")
