"""Reply trees: root-to-leaf paths by iterative self-joins, ranked and formatted as conversations.

Jumps to the parent are joined with themselves, so a chain of any length is
followed in as many rounds as its depth has binary digits; the same jumps
unfold the chosen leaves into their paths.  A path is stored as one segment
per turn, to be read in order: no conversation is ever gathered in one row.

Template: a conversation starts with ``<s>``; user turns are
``[INST] text [/INST]``, assistant turns `` text </s>``, system turns
``<<SYS>> text <</SYS>>``, others ``<|role|> text <|end|>`` with the role
URL-encoded.  A control string inside a text gets a backslash after its first
character (one more if it has some), which reading takes away again.

Null roles and texts are read as empty; nodes without a stored parent are roots; repeated rows
are nodes of their own where ids are given by ``chained``.  A cycle of parents
raises.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from urllib.parse import unquote_plus

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnstile.llm.common import document_columns, query, staged, table
from turnstile.llm.shuffle import numbered

#: What follows the first character of each control string, by that character.
CONTROL = r"(?:(?<=\[)\\*(?:INST\]|/INST\])|(?<=<)\\*(?:s>|/s>|<SYS>>|</SYS>>|\|))"


def paths(nodes: DataFrame, keep: int = 1) -> DataFrame:
    """tree, leaf, place (from 0), node: the ``keep`` best branches of each tree.

    ``nodes`` has tree, node (unique), parent (null at a root) and score; a branch's score is the mean over
    its nodes, ties to the smaller leaf.
    """
    nodes = document_columns(nodes, "tree", "node", "parent", "score")
    known = nodes.select(F.col("node").alias("parent"))
    edges = nodes.join(known, "parent", "left_semi")
    roots = nodes.join(edges.select("node"), "node", "left_anti").withColumn("parent", F.lit(None).cast("long")).select(*edges.columns)
    state = staged(
        edges.unionByName(roots).select("tree", "node", F.col("parent").alias("jump"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("total"), F.lit(1).cast("long").alias("nodes")),
        "replies",
    )
    n, jumps = state.count(), []
    first = state
    while (left := state.where("jump is not null")).take(1):
        if 2 ** len(jumps) > n:
            raise ValueError("replies form a cycle")
        jumps.append(left.select("node", "jump"))
        above = state.select(F.col("node").alias("jump"), F.col("jump").alias("further"), F.col("total").alias("more"), F.col("nodes").alias("nodes_more"))
        # Nodes that have reached their root are done; the deeper half of the rest goes on.
        further = left.join(above, "jump").select("tree", "node", F.col("further").alias("jump"), (F.col("total") + F.col("more")).alias("total"), (F.col("nodes") + F.col("nodes_more")).alias("nodes"))
        state = staged(further.unionByName(state.where("jump is null").select(*further.columns)), "replies")
    leaves = state.join(first.select(F.col("jump").alias("node")).where("node is not null"), "node", "left_anti")
    by_score = Window.partitionBy("tree").orderBy((F.col("total") / F.col("nodes")).desc(), "node")
    chosen = leaves.withColumn("_rank", F.row_number().over(by_score)).where(F.col("_rank") <= keep)
    path = chosen.select("tree", F.col("node").alias("leaf"), (F.col("nodes") - 1).alias("place"), "node")
    for k, jump in enumerate(jumps):
        path = staged(path.unionByName(path.join(jump, "node").select("tree", "leaf", (F.col("place") - 2**k).alias("place"), F.col("jump").alias("node"))), "paths")
    return path


def formatted(turns: DataFrame) -> DataFrame:
    """Segments of conversations: the columns but for the text, with ``segment`` and the place of the loss in it.

    ``turns`` has conv, place, role and text; loss_at and loss_chars count code
    points of the segment and cover the assistant's text.
    """
    text = F.regexp_replace(F.coalesce("text", F.lit("")), CONTROL, r"\\$0")
    role = F.coalesce("role", F.lit(""))
    begin = F.when(F.col("place") == 0, "<s>").otherwise("")
    before = F.when(role == "user", "[INST] ").when(role == "assistant", " ").when(role == "system", "<<SYS>> ").otherwise(F.concat(F.lit("<|"), F.url_encode(role), F.lit("|> ")))
    after = F.when(role == "user", " [/INST]").when(role == "assistant", " </s>").when(role == "system", " <</SYS>>").otherwise(" <|end|>")
    return turns.select(
        "conv",
        "place",
        F.concat(begin, before, text, after).alias("segment"),
        F.when(role == "assistant", F.char_length(F.concat(begin, before))).alias("loss_at"),
        F.when(role == "assistant", F.char_length(text)).alias("loss_chars"),
    )


SEGMENT = re.compile(r"(?:<s>)?(?:\[INST\] (?P<user>.*) \[/INST\]| (?P<assistant>.*) </s>|<<SYS>> (?P<system>.*) <</SYS>>|<\|(?P<role>[^|]*)\|> (?P<other>.*) <\|end\|>)", re.DOTALL)
ESCAPED = re.compile(r"(?:(?<=\[)\\(?=\\*(?:INST\]|/INST\]))|(?<=<)\\(?=\\*(?:s>|/s>|<SYS>>|</SYS>>|\|)))")


def read_segment(segment: str) -> tuple[str, str]:
    """Role and text that a segment was made of."""
    found = SEGMENT.fullmatch(segment)
    if not found:
        raise ValueError(f"not a turn: {segment[:80]!r}")
    role, text = next((k, v) for k, v in found.groupdict().items() if v is not None and k != "role")
    return unquote_plus(found["role"]) if role == "other" else role, ESCAPED.sub("", text)


def digests(segments: DataFrame) -> DataFrame:
    """Counts and digests per conversation, read back from its segments, which stream past in order."""

    def work(batches):
        conv, n, turns, loss, loss_chars, chars = None, 0, hashlib.sha256(), hashlib.sha256(), 0, 0

        def row():
            return [conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars]

        def batch_of(rows):
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            done = []
            for own, segment, at, length in zip(*(batch.column(c).to_pylist() for c in ("conv", "segment", "loss_at", "loss_chars")), strict=True):
                if n and own != conv:
                    done.append(row())
                    n, turns, loss, loss_chars, chars = 0, hashlib.sha256(), hashlib.sha256(), 0, 0
                conv, n, chars = own, n + 1, chars + len(segment)
                role, text = read_segment(segment)
                turns.update(f"{role}\n{text}\n".encode())
                if at is not None:
                    kept = ESCAPED.sub("", segment[at : at + length])
                    loss.update(kept.encode())
                    loss_chars += len(kept)
            if done:
                yield batch_of(done)
        if n:
            yield batch_of([row()])

    ordered = segments.repartition("conv").sortWithinPartitions("conv", "place").select("conv", "segment", "loss_at", "loss_chars")
    return ordered.mapInArrow(work, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def chained(rows: DataFrame, conv: str, order: list[str]) -> DataFrame:
    """Rows as a tree of one branch per conversation: each replies to the one before it in the given order."""
    rows = numbered(rows, [conv, *order], "node")
    first = rows.groupBy(conv).agg(F.min("node").alias("_first"))
    tree = rows.join(first, rows[conv].eqNullSafe(first[conv]), "left").drop(first[conv])
    return tree.withColumn("tree", F.col("_first")).withColumn("parent", F.when(F.col("node") > F.col("_first"), F.col("node") - 1)).drop("_first")


def conversations(nodes: DataFrame, keep: int = 1) -> DataFrame:
    """Segments of the best branches; ``nodes`` also has conv, role and text.  A conversation keeps the id of its tree."""
    found = paths(nodes, keep)
    turns = found.join(document_columns(nodes, "node", "conv", "role", "text"), "node")
    return staged(formatted(turns), "segments")


SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]', 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]', 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)) AS turns_sha256,
  CAST(coalesce(sum(length(x)) FILTER (r = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(x, '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) FILTER (r = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(length(x) + len(regexp_extract_all(x, '\[\\*(?:INST\]|/INST\])|<\\*(?:s>|/s>|<SYS>>|</SYS>>|\|)'))
    + CASE r WHEN 'user' THEN 15 WHEN 'assistant' THEN 6 WHEN 'system' THEN 17 ELSE 13 + length(replace(url_encode(r), '%20', '+')) END) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


@query("op10_reply_trees", SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    rows = document_columns(table(spark, folder, "conversations"), "conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    nodes = chained(rows.unionByName(own), "conv_id", ["turn", "role", "text"])
    nodes = staged(nodes.select("tree", "node", "parent", F.lit(0.0).alias("score"), F.col("conv_id").alias("conv"), "role", "text"), "turns")
    return digests(conversations(nodes))
