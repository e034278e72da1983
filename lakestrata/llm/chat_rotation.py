"""Operator 10: multi-party perspective rotation of chats.

For every participant the dialogue is rendered once with this speaker as the assistant and the others as
named users; the mask marks the characters of the assistant's turns (text and end mark), which are the ones
to train on. System turns stay system turns, at their place, in every rendering.

With ``whole=True``, which the query uses, a rendering is the whole dialogue for every speaker of the conversation, in
rows by ``segment`` (``SEGMENT`` turn numbers) and ``part``: put together in this order they are the dialogue, whatever
its length, and masks and ``start`` run on over all of them. So no conversation is gathered in one row: where rows begin
follows from the lengths of the rows before, which are numbers per row and speaker. Should more than ``MAX_ROWS`` rows
share a segment (equal or null turn numbers), it has several parts, in the order of the turns. A conversation of any
length is rendered as often as it has speakers; that is the result, not a step on the way.

Without ``whole`` a segment is rendered by itself, for the speakers in it only.

Defined results: turns are ordered by turn number, role and text; repeated rows are one turn; a null turn
number comes last, a null role is the participant ``unknown``, a null text is empty; null ids are one conversation; a
conversation (without ``whole``: a segment) of system turns only gives no row; ``<|`` in texts and names is spaced, so no
text can forge a mark; other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestrata.llm.tables import Scratch, documents

SEGMENT = 64
MAX_ROWS = 4096
SYSTEM_ROLES = ("system",)
LAST_TURN = 1 << 62
END = "<|end|>\n"
OWN_HEAD = "<|assistant|>\n"


def _safe(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def _in_parts(t: DataFrame) -> DataFrame:
    """The distinct turns with their ``part`` of the segment: ``MAX_ROWS`` turns each, in order. Crowded segments
    only are sorted, over all tasks."""
    crowd = t.groupBy("id", "segment").agg(F.count("*").alias("rows")).filter(F.col("rows") > MAX_ROWS)
    scratch = Scratch(t.sparkSession, "chat")
    crowd = scratch.keep(crowd.select(F.col("id").alias("__id"), F.col("segment").alias("__segment")), "crowd")
    if not crowd.limit(1).count():
        return t.distinct().withColumn("part", F.lit(0).cast("long"))
    crowded = F.col("id").eqNullSafe(F.col("__id")) & (F.col("segment") == F.col("__segment"))
    dense = t.join(crowd, crowded, "left_semi").distinct()
    order = ("id", "turn", "role", "text")
    dense = dense.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    dense = scratch.keep(dense.withColumn("run", F.shiftright("at", 33)), "dense")
    # a run is what one task has of a segment
    runs = dense.groupBy("id", "segment", "run").agg(F.min("at").alias("least"), F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.partitionBy("id", "segment").orderBy("run")) - F.col("rows")
    runs = runs.select(F.col("id").alias("__id"), F.col("segment").alias("__segment"), F.col("run").alias("__run"), (before - F.col("least")).alias("shift"))
    dense = dense.join(runs, crowded & (F.col("run") == F.col("__run")))
    dense = dense.withColumn("part", F.floor((F.col("at") + F.col("shift")) / F.lit(MAX_ROWS)))
    rest = t.join(crowd, crowded, "left_anti").distinct().withColumn("part", F.lit(0).cast("long"))
    return rest.unionByName(dense.select(*rest.columns))


def _clean(turns: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str, segment: int) -> DataFrame:
    t = turns.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(turn_col).cast("long"), F.lit(LAST_TURN)).alias("turn"),
        _safe(F.coalesce(F.col(role_col), F.lit("unknown"))).alias("role"), _safe(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    return t.withColumn("segment", F.floor(F.col("turn") / F.lit(segment)))


def _user_head(role: Column) -> Column:
    return F.concat(F.lit("<|user "), role, F.lit("|>\n"))


def _head(x: Column, speaker: Column, system_roles: tuple[str, ...]) -> Column:
    return (F.when(x["role"] == speaker, F.lit(OWN_HEAD)).when(x["role"].isin(*system_roles), F.lit("<|system|>\n"))
            .otherwise(_user_head(x["role"])))


def _rendered(rows: DataFrame, id_col: str, system_roles: tuple[str, ...]) -> DataFrame:
    """Rows with ``turns``, ``speaker`` and ``start``, the characters before them, as text and mask."""
    def piece(x: Column) -> Column:
        return F.struct(_head(x, F.col("speaker"), system_roles).alias("head"), F.concat(x["text"], F.lit(END)).alias("body"), (x["role"] == F.col("speaker")).alias("own"))

    rows = rows.withColumn("pieces", F.transform("turns", piece))
    span = F.struct
    walk = F.aggregate(
        "pieces", span(F.col("start").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("mask")),
        lambda s, x: span(
            (s["at"] + F.length(x["head"]) + F.length(x["body"])).alias("at"),
            F.when(x["own"], F.concat(s["mask"], F.array(span((s["at"] + F.length(x["head"])).alias("start"),
                                                              (s["at"] + F.length(x["head"]) + F.length(x["body"])).alias("end")))))
            .otherwise(s["mask"]).alias("mask")))
    rows = rows.withColumn("mask", walk["mask"])
    return rows.select(
        F.col("id").alias(id_col), "segment", "part", "speaker", "start", F.size("pieces").cast("long").alias("n_turns"), F.size("mask").cast("long").alias("n_own"),
        F.array_join(F.transform("pieces", lambda x: F.concat(x["head"], x["body"])), "").alias("text"), "mask")


def _whole_starts(seg: DataFrame, who: DataFrame, system_roles: tuple[str, ...]) -> DataFrame:
    """(key, segment, part, speakers): each speaker of the conversation with where the row begins in their rendering. The
    length of a row is its length with users only, and the difference of the two heads for each own turn."""
    as_user = F.aggregate("turns", F.lit(0).cast("long"), lambda s, x: s + F.length(_head(x, F.lit(None).cast("string"), system_roles)) + F.length(x["text"]) + len(END))
    base = seg.select("key", "segment", "part", as_user.alias("base"))
    own = seg.select("key", "segment", "part", F.explode(F.col("turns.role")).alias("speaker")).groupBy("key", "segment", "part", "speaker").agg(F.count("*").alias("own"))
    grid = base.join(who, "key").join(own, ["key", "segment", "part", "speaker"], "left")
    length = F.col("base") + F.coalesce("own", F.lit(0)) * (len(OWN_HEAD) - F.length(_user_head(F.col("speaker"))))
    before = Window.partitionBy("key", "speaker").orderBy("segment", "part").rowsBetween(Window.unboundedPreceding, -1)
    grid = grid.withColumn("start", F.coalesce(F.sum(length).over(before), F.lit(0)).cast("long"))
    return grid.groupBy("key", "segment", "part").agg(F.collect_list(F.struct("speaker", "start")).alias("speakers"))


def rotate(turns: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           system_roles: tuple[str, ...] = SYSTEM_ROLES, segment: int = SEGMENT, whole: bool = False) -> DataFrame:
    """(id, segment, part, speaker, start, n_turns, n_own, text, mask): ``mask`` holds the (start, end) characters
    of the speaker's turns, counted from the beginning of the whole dialogue, ``start`` those before this row; without
    ``whole`` they count from the row's own beginning."""
    t = _clean(turns, id_col, turn_col, role_col, text_col, segment)
    # nulls are equal inside a struct, so null ids are one conversation in joins as well
    t = t.withColumn("key", F.struct("id"))
    seg = _in_parts(t).groupBy("key", "segment", "part").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    who = t.filter(~F.col("role").isin(*system_roles)).select("key", "segment", F.col("role").alias("speaker"))
    if whole:
        starts = _whole_starts(seg, who.select("key", "speaker").distinct(), system_roles)
        rows = seg.join(starts, ["key", "segment", "part"]).withColumn("of", F.explode("speakers")).withColumns({"speaker": F.col("of.speaker"), "start": F.col("of.start")})
    else:
        rows = seg.join(who.distinct(), ["key", "segment"]).withColumn("start", F.lit(0).cast("long"))
    return _rendered(rows.withColumn("id", F.col("key.id")), id_col, system_roles)


def op10_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rotate(documents(spark, sf_dir, "conversations"), whole=True)
    spans = F.array_join(F.transform("mask", lambda x: F.concat_ws("-", x["start"].cast("string"), x["end"].cast("string"))), ",")
    return out.select("conv_id", "segment", "part", "speaker", "start", "n_turns", "n_own", "text", spans.alias("mask"))


QUERIES = {"op10_chat_rotation": op10_chat_rotation}

ORACLES = {"op10_chat_rotation": f"""
WITH t AS (
  SELECT DISTINCT conv_id, CAST(coalesce(turn, {LAST_TURN}) AS BIGINT) AS turn, replace(coalesce(role, 'unknown'), '<|', '< |') AS role,
         replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations),
g AS (SELECT *, CAST(floor(turn / {SEGMENT}) AS BIGINT) AS segment FROM t),
s AS (SELECT *, CAST((row_number() OVER (PARTITION BY conv_id, segment ORDER BY turn, role, text) - 1) // {MAX_ROWS} AS BIGINT) AS part FROM g),
p AS (SELECT DISTINCT conv_id, role AS speaker FROM s WHERE role <> 'system'),
r AS (
  SELECT p.conv_id, s.segment, s.part, p.speaker, s.turn, s.role, s.text, s.role = p.speaker AS own,
         CASE WHEN s.role = p.speaker THEN '<|assistant|>' WHEN s.role = 'system' THEN '<|system|>' ELSE '<|user ' || s.role || '|>' END || chr(10) AS head,
         s.text || '<|end|>' || chr(10) AS body
  FROM p JOIN s ON p.conv_id IS NOT DISTINCT FROM s.conv_id),
w AS (
  SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, speaker ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS upto FROM r)
SELECT conv_id, segment, part, speaker, CAST(min(upto - length(head) - length(body)) AS BIGINT) AS start, count(*) AS n_turns, count(*) FILTER (own) AS n_own,
       string_agg(head || body, '' ORDER BY turn, role, text) AS text,
       coalesce(string_agg(CAST(CAST(upto - length(body) AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(upto AS BIGINT) AS VARCHAR), ',' ORDER BY turn, role, text) FILTER (own), '') AS mask
FROM w GROUP BY conv_id, segment, part, speaker
"""}
