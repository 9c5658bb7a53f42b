"""Chat formatting of reply trees.

Messages form trees by parent links.  Ancestor links are doubled by self-joins (1, 2, 4, ... steps up), and
every leaf's path to its root is enumerated with them in as many rounds as the depth has bits.  Branches of
a tree are ranked by the sum of their messages' scores (ties: the smaller leaf), and each chosen path is
formatted as one conversation.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` a turn.  Inside roles and texts ``\\`` becomes ``\\\\``, the
``<|`` of a control string becomes ``<\\|``, and a line end in a role ``\\n``; ``read_back`` undoes that.  The loss
mask is a list of [start, end) spans in code points over the formatted text: the assistants' texts.

Defined results: null texts and roles count as empty; a message whose parent is missing is a root; messages
on a cycle of parents have no root and are left out; trees without messages don't exist; messages whose tree
is null are one tree.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hearth.llm.scratch import dropped, stored, tidy
from hearth.llm.textbatch import column, few_rows

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)
_ESCAPED = re.compile(r"\\([\\n])|<\\\|")


def paths(messages: DataFrame) -> DataFrame:
    """(tree, leaf, node, up): for each leaf the nodes on its way to the root, up counted from the leaf.

    messages: tree, node, parent, with unique (tree, node) and no null tree (format_branches wraps trees in a struct).
    """
    here = messages.select("tree", "node").alias("m")
    own = messages.join(messages.select("tree", F.col("node").alias("parent"), F.lit(True).alias("there")), ["tree", "parent"], "left")
    jump = stored(own.where("there").select("tree", "node", F.col("parent").alias("above")))
    leaves = here.join(jump.select("tree", F.col("above").alias("node")), ["tree", "node"], "left_anti")
    found = stored(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up")))
    limit = messages.count()
    step = 1
    while step <= limit and not jump.isEmpty():
        more = found.join(jump, ["tree", "node"]).select("tree", "leaf", F.col("above").alias("node"), (F.col("up") + step).alias("up"))
        higher = jump.alias("a").join(jump.select("tree", F.col("node").alias("above"), F.col("above").alias("top")).alias("b"), ["tree", "above"]).select("tree", "node", F.col("top").alias("above"))
        grown, further = stored(found.union(more)), stored(higher)
        dropped(found, jump)
        found, jump, step = grown, further, 2 * step
    return found


def chosen(messages: DataFrame, best: int) -> DataFrame:
    """(tree, leaf, branch, node, up) of each tree's best branches; branch counts from 1. messages: tree, node, parent, score."""
    every = paths(messages)
    total = every.join(messages.select("tree", "node", "score"), ["tree", "node"]).groupBy("tree", "leaf").agg(F.sum(F.coalesce("score", F.lit(0.0))).alias("total"))
    ranked = total.withColumn("branch", F.row_number().over(W.partitionBy("tree").orderBy(F.desc("total"), "leaf"))).where(F.col("branch") <= best)
    return every.join(ranked.select("tree", "leaf", "branch"), ["tree", "leaf"])


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "<|" if m[1] is None else "\n" if m[1] == "n" else "\\", text)


def grouped_index(df: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """df with each row's place in its group (1, 2...; null is a group) by order, nulls first: rows are dealt into ranges, so that no task holds a group of any size."""
    ranged = stored(df.repartitionByRange(*by, *order).withColumn("part_", F.spark_partition_id()))
    counts = ranged.groupBy("part_", *by).agg(F.count("*").alias("n_"))
    before = F.coalesce(F.sum("n_").over(W.partitionBy(*by).orderBy("part_").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    past = counts.select(F.col("part_").alias("p_"), *[F.col(c).alias(f"of_{c}") for c in by], before.alias("before_"))
    place = F.row_number().over(W.partitionBy("part_", *by).orderBy(*order))
    same = [F.col("part_") == F.col("p_"), *[F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in by]]
    return ranged.withColumn("place_", place).join(past, same).select(*df.columns, (F.col("place_") + F.col("before_")).alias(name))


@tidy
def format_branches(messages: DataFrame, best: int = 1) -> DataFrame:
    """(tree, branch, conversation, loss_spans). messages: tree, node, parent, role, text, score."""
    messages = stored(messages.withColumn("tree", F.struct(F.col("tree").alias("key"))))  # never null; read several times
    way = chosen(messages.select("tree", "node", "parent", "score"), best)
    role = F.replace(escaped(F.coalesce("role", F.lit(""))), F.lit("\n"), F.lit("\\n"))
    turns = messages.select("tree", "node", role.alias("role"), escaped(F.coalesce("text", F.lit(""))).alias("text"))
    rows = way.join(turns, ["tree", "node"]).groupBy("tree", "branch").agg(F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("at"), "role", "text"))).alias("turns"))
    head = lambda t: F.concat(F.lit(OPEN), t["role"], F.lit("\n"))
    whole = lambda t: F.concat(head(t), t["text"], F.lit(CLOSE + "\n"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start: int, end: int>>").alias("spans"))

    def add(state: Column, t: Column) -> Column:
        begin = state["at"] + F.length(head(t))
        span = F.array(F.struct(begin.alias("start"), (begin + F.length(t["text"])).alias("end")))
        return F.struct((state["at"] + F.length(whole(t))).alias("at"), F.when(t["role"] == "assistant", F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    spans = F.aggregate("turns", start, add, lambda s: s["spans"])
    return rows.select(F.col("tree.key").alias("tree"), "branch", F.array_join(F.transform("turns", whole), "").alias("conversation"), spans.alias("loss_spans"))


def read_turns(conversation: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(conversation)]


def read_back(formatted: DataFrame, keep: list[str]) -> DataFrame:
    """keep, and digests of what the formatted text and its loss mask hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for text, spans in zip(column(b, "conversation"), column(b, "loss_spans"), strict=True):
                text, spans = text.as_py(), spans.as_py()
                turns = read_turns(text)
                loss = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
                digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
                for column_, x in zip(out, (len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), digest(loss), len(text)), strict=True):
                    column_.append(x)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([*(column(b, c) for c in keep), *(pa.array(x, k) for x, k in zip(out, kinds, strict=True))], [*keep, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    few_rows(formatted)
    types = "".join(f"`{c}` {t}, " for c, t in formatted.select(*[F.col(f"`{c}`") for c in keep]).dtypes)
    return formatted.mapInArrow(run, f"{types}n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def chain(rows: DataFrame, tree: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Linear conversations as trees: each row's parent is the row before it by turn (nulls first; ties: role, text). Rows may repeat; long conversations spread over tasks."""
    slim = rows.select(F.col(tree).alias("tree"), F.col(turn).alias("turn"), "role", "text")
    made = grouped_index(slim, ["tree"], ["turn", "role", "text"], "node").select("tree", "node", "role", "text")
    return made.withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1)).withColumn("score", F.lit(0.0))
