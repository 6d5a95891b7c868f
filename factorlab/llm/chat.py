"""Reply trees as training conversations (operator 5, DataFrame functions only).

1. Iterative self-joins double the step of every message's ancestor link, with the score summed over
   the step, so a tree of depth d takes about log2(d) rounds. A round's table is written.
2. Leaves are ranked within their tree by mean score (ties: longer path, then smaller leaf id) and
   the best ``paths`` are kept.
3. The chosen leaves are expanded to their root-to-leaf paths by the same links, again by doubling.
4. A path becomes one string: ``### {role}: {text} </turn>`` and a line break per turn. Control
   strings inside roles and texts are escaped with a backslash, reversibly. The loss mask lists
   the byte spans of the assistant texts.

``read_back`` parses the formatted string into turns again, and the masked bytes into the loss text.

Defined cases: a null role or text is empty; a message whose parent is missing from its tree (or is
itself) is a root; messages in a cycle of parents have no root and are in no path; rows without msg_id
are leaves of their own; among repeated rows of a msg_id the first by (role, text, score) is used;
null tree ids are one tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factorlab.llm.common import written

OPEN, ROLE_END, CLOSE = "### ", ": ", " </turn>\n"
LOSS_ROLE = "assistant"


# ------------------------------------------------------------------ template

def escape(text: Column) -> Column:
    r"""No ``###`` and no ``</turn>`` is left: backslash doubled, ``#`` after ``#`` -> ``\h``, ``</`` -> ``<\t``."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(text, F.lit("##"), F.lit("#\\h")), F.lit("</"), F.lit("<\\t"))


def unescape(text: Column) -> Column:
    pieces = F.split(text, r"\\\\")   # doubled backslashes first: the marks end in a letter
    plain = F.transform(pieces, lambda p: F.replace(F.replace(p, F.lit("\\h"), F.lit("#")), F.lit("\\t"), F.lit("/")))
    return F.array_join(plain, "\\")


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("\\c"))


def _unescape_role(role: Column) -> Column:
    pieces = F.transform(F.split(role, r"\\\\"), lambda p: F.replace(F.replace(F.replace(
        p, F.lit("\\c"), F.lit(":")), F.lit("\\h"), F.lit("#")), F.lit("\\t"), F.lit("/")))
    return F.array_join(pieces, "\\")


# ------------------------------------------------------------------ trees

def _links(messages: DataFrame) -> DataFrame:
    """``(tree, id, up, step, score, root)``: the ancestor reached and the scores on the way."""
    parents = messages.select("tree", F.col("id").alias("up"), F.lit(True).alias("known"))
    linked = messages.join(parents, ["tree", "up"], "left")
    has_parent = F.col("known").isNotNull() & (F.col("up") != F.col("id"))
    return linked.select("tree", "id", F.when(has_parent, F.col("up")).alias("up"),
                         F.lit(1).cast("long").alias("step"), "score")


def ancestor_tables(messages: DataFrame) -> list[DataFrame]:
    """Table k links every message to its ancestor 2^k steps up, with the score of the messages
    from itself up to just below that ancestor; the last table reaches every root."""
    tables = [written(_links(messages), "links-0")]
    count = tables[0].count()
    while tables[-1].filter("up IS NOT NULL").limit(1).count() and 2 ** (len(tables) - 1) <= count:
        now = tables[-1]
        above = now.select("tree", F.col("id").alias("up"), F.col("up").alias("far"), F.col("step").alias("more"),
                           F.col("score").alias("rest"))
        # messages that have reached their root take no further part in the join
        doubled = now.filter("up IS NOT NULL").join(above, ["tree", "up"], "left").select(
            "tree", "id", F.col("far").alias("up"), (F.col("step") + F.coalesce("more", F.lit(0))).alias("step"),
            (F.col("score") + F.coalesce("rest", F.lit(0.0))).alias("score"))
        arrived = now.filter("up IS NULL").select("tree", "id", "up", "step", "score")
        tables.append(written(doubled.unionByName(arrived), f"links-{len(tables)}"))
    return tables


def best_leaves(tables: list[DataFrame], paths: int | None) -> DataFrame:
    """``(tree, leaf, depth, score, path_rank)`` of the best ``paths`` leaves per tree (None: all)."""
    first, last = tables[0], tables[-1]
    parents = first.filter("up IS NOT NULL").select("tree", F.col("up").alias("id")).distinct()
    leaves = (last.filter("up IS NULL").join(parents, ["tree", "id"], "left_anti")
              .select("tree", F.col("id").alias("leaf"), F.col("step").alias("depth"),
                      (F.col("score") / F.col("step")).alias("score")))
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), F.desc("depth"), "leaf"))
    ranked = leaves.withColumn("path_rank", rank)
    return ranked if paths is None else ranked.filter(F.col("path_rank") <= paths)


def expand_paths(tables: list[DataFrame], leaves: DataFrame) -> DataFrame:
    """``(tree, leaf, id, up_steps)``: every message on the path of every chosen leaf."""
    path = leaves.select("tree", "leaf", F.col("leaf").alias("id"), F.lit(0).cast("long").alias("up_steps"))
    for k, table in enumerate(tables):
        jump = table.filter("up IS NOT NULL").select("tree", "id", "up")
        further = path.join(jump, ["tree", "id"]).select(
            "tree", "leaf", F.col("up").alias("id"), (F.col("up_steps") + 2 ** k).alias("up_steps"))
        path = written(path.unionByName(further), f"paths-{k}")
    return path


def conversations(messages: DataFrame, paths: int | None = 1) -> DataFrame:
    """``(tree_id, leaf_id, path_rank, path_score, n_turns, formatted, loss_spans)`` per chosen path.

    ``messages`` has tree_id, msg_id, parent_id, role, text and score. ``loss_spans`` are
    ``(start, stop)`` byte offsets in the UTF-8 of ``formatted``.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    named = messages.select(
        F.col("tree_id").isNull().alias("no_tree"), F.coalesce(F.col("tree_id").cast("long"), F.lit(0)).alias("tree_key"),
        F.col("msg_id").cast("long").alias("id"), F.col("parent_id").cast("long").alias("up"), text("role").alias("role"),
        text("text").alias("text"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    named = named.select(F.struct("no_tree", "tree_key").alias("tree"), "id", "up", "role", "text", "score")
    loose = named.filter("id IS NULL")
    unique = named.filter("id IS NOT NULL").groupBy("tree", "id").agg(
        F.min(F.struct("role", "text", "score", "up")).alias("m")).select("tree", "id", "m.up", "m.role", "m.text", "m.score")
    unique = written(unique, "messages")
    tables = ancestor_tables(unique.select("tree", "id", "up", "score"))
    leaves = written(best_leaves(tables, paths), "leaves")
    steps = expand_paths(tables, leaves).join(leaves.drop("score"), ["tree", "leaf"])
    turns = steps.join(unique.select("tree", "id", "role", "text"), ["tree", "id"]).select(
        "tree", "leaf", "path_rank", (F.col("depth") - 1 - F.col("up_steps")).alias("at"), "role", "text")
    alone = loose.select("tree", F.lit(None).cast("long").alias("leaf"), F.lit(None).cast("int").alias("path_rank"),
                         F.lit(0).cast("long").alias("at"), "role", "text",
                         F.monotonically_increasing_id().alias("extra"))
    turns = turns.withColumn("extra", F.lit(-1).cast("long")).unionByName(alone)
    head = F.concat(F.lit(OPEN), _escape_role(F.col("role")), F.lit(ROLE_END))
    turns = turns.select("tree", "leaf", "path_rank", "extra", "at", "role", head.alias("head"), escape(F.col("text")).alias("body"))
    long = lambda c: F.octet_length(c).cast("long")
    segment = long("head") + long("body") + len(CLOSE)
    before = F.sum(segment).over(Window.partitionBy("tree", "leaf", "extra").orderBy("at")) - segment
    start = before + long("head")
    turns = turns.select("tree", "leaf", "path_rank", "extra", F.struct(
        "at", F.concat("head", "body", F.lit(CLOSE)).alias("segment"), (F.col("role") == LOSS_ROLE).alias("loss"),
        start.alias("start"), (start + long("body")).alias("stop")).alias("turn"))
    whole = turns.groupBy("tree", "leaf", "path_rank", "extra").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    spans = F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: F.struct(t["start"].alias("start"), t["stop"].alias("stop")))
    scores = leaves.select("tree", "leaf", F.col("score").alias("path_score"))
    return whole.join(scores, ["tree", "leaf"], "left").select(
        F.when(~F.col("tree.no_tree"), F.col("tree.tree_key")).alias("tree_id"), F.col("leaf").alias("leaf_id"),
        "path_rank", "path_score", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.col("turns.segment"), "").alias("formatted"), spans.alias("loss_spans"))


# ------------------------------------------------------------------ reading back

def read_back(formatted: DataFrame) -> DataFrame:
    """Add ``turns`` (role, text) parsed from ``formatted`` and ``loss_text`` read through the mask."""
    marker = F.split("formatted", CLOSE)   # the last part is empty
    segments = F.slice(marker, 1, F.size(marker) - 1)
    length = len(OPEN)

    def turn(segment: Column) -> Column:
        body = F.call_function("substring", segment, F.lit(length + 1))
        cut = F.call_function("instr", body, F.lit(ROLE_END))
        return F.struct(_unescape_role(F.call_function("left", body, cut - 1)).alias("role"),
                        unescape(F.call_function("substring", body, cut + len(ROLE_END))).alias("text"))

    data = F.encode("formatted", "UTF-8")
    masked = F.transform("loss_spans", lambda s: unescape(F.decode(F.call_function(
        "substring", data, (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int")), "UTF-8")))
    return formatted.withColumns({"turns": F.transform(segments, turn), "loss_text": F.array_join(masked, "")})


def chain(rows: DataFrame) -> DataFrame:
    """Messages of plain conversations ``(conv_id, turn, role, text)``: each turn answers the one before.

    Repeated rows and ties of a turn are turns of their own, ordered by (turn, role, text); a null
    turn comes first.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    numbered = rows.select("conv_id", "role", "text", F.row_number().over(order).cast("long").alias("n"))
    return numbered.select(F.col("conv_id").alias("tree_id"), F.col("n").alias("msg_id"),
                           F.when(F.col("n") > 1, F.col("n") - 1).alias("parent_id"), "role", "text",
                           F.lit(0.0).alias("score"))


PROBE = r"\### Assistant: </turn> ok"


def query(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(PROBE).alias("text"))
    read = read_back(conversations(chain(rows.unionByName(probe))))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        F.col("tree_id").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


#: The contract's columns from the rows themselves; only ``formatted_chars`` needs the template.
ORACLE = r"""
WITH all_rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
escaped AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '##', '#\h'), '</', '<\t') AS safe_text,
    replace(replace(replace(replace(role, '\', '\\'), '##', '#\h'), '</', '<\t'), ':', '\c') AS safe_role FROM all_rows),
told AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(length('### ' || safe_role || ': ' || safe_text || ' </turn>' || chr(10))) AS formatted_chars
  FROM escaped GROUP BY conv_id)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM told
"""
