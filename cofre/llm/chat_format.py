"""Chat formatting as a prefix tree.

Turns are written as ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings inside roles and texts are escaped so that
they can be read back: ``&`` becomes ``&amp;``, ``<|`` becomes ``&lt;|`` and, in roles, a line end ``&nl;``.

Conversations that begin with the same turns share them: a node is the chain of turns up to it, named by a running
digest, and is emitted once. Nodes are laid out depth-first in one sequence: conversations are sorted by their chains of
nodes, each node belongs to the first conversation that has it, and starts are running sums, by range partition and then
over the partitions. A node's position is the number of tokens of its ancestors, and its ancestor intervals are the parts
of the sequence it may attend to beside itself; neighbouring parts are one interval.

Turns of a conversation are streamed in order, so a long conversation needs no buffer for its texts. A first turn or a
whole conversation that a third of all conversations share is one row per task before it is shuffled.

Tokens are code points unless a tokenizer file is named, which every executor must be able to read.

Defined results: a null text or role is empty; null turns come first; equal turn numbers are ordered by role and text,
and a repeated row is a turn of its own; rows without conversation id are one conversation. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cofre.llm.common import Scratch

# Fixed values of the template.
START, END = "<|im_start|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"


def escape(text: str) -> str:
    return text.replace("&", "&amp;").replace("<|", "&lt;|")


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "&nl;")


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&nl;"), F.lit("\n")))


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _chain(tokenizer: str | None) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Rows come by conversation, in order. Adds node, parent, depth, position, and the formatted turn."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, node, depth, position = object(), b"", 0, 0
        for batch in batches:
            found = []
            for conversation, role, text in zip(batch["conversation"], batch["role"], batch["text"], strict=True):
                if conversation != current:
                    current, node, depth, position = conversation, b"", 0, 0
                head = f"{START}{escape_role(role)}\n"
                said = escape(text)
                body = head + said + END
                size = len(_tokenizer(tokenizer).encode(body, add_special_tokens=False).ids) if tokenizer else len(body)
                parent, node = node, hashlib.blake2b(node + body.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                loss = (len(head), len(head) + len(said)) if role == LOSS_ROLE else (None, None)
                found.append((conversation, node, parent or None, depth, role, body, size, position, *loss))
                depth, position = depth + 1, position + size
            yield pd.DataFrame(found, columns=[name.split()[0] for name in _TURN.split(", ")])

    return run


_TURN = (
    "conversation string, node binary, parent binary, depth int, role string, body string, n_tokens int, position long, "
    "loss_from int, loss_to int"
)


@dataclass(frozen=True)
class PrefixTree:
    """nodes: node, parent, tree, depth, role, body, n_tokens, start, position, ancestors (array of from, to), loss_from,
    loss_to (code points of body under the loss mask). chains: conversation (as text), leaf, n_turns. paths: leaf, nodes."""

    nodes: DataFrame
    chains: DataFrame
    paths: DataFrame


def _ancestors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = []
        for path in batch["path"]:
            spans: list[list[int]] = []
            for step in path:
                if step["is_first"]:
                    found.append((step["node"], path[0]["node"], [{"from": a, "to": b} for a, b in spans]))
                end = step["start"] + step["n_tokens"]
                if spans and spans[-1][1] == step["start"]:
                    spans[-1][1] = end
                else:
                    spans.append([step["start"], end])
        if found:
            yield pd.DataFrame(found, columns=["node", "tree", "ancestors"])


def build_tree(
    df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", tokenizer: str | None = None
) -> PrefixTree:
    scratch = Scratch(df.sparkSession, "chat")
    rows = df.select(
        F.coalesce(F.concat(F.lit("="), F.col(conversation).cast("string")), F.lit("")).alias("conversation"), F.col(turn).alias("turn"),
        *[F.coalesce(F.col(c), F.lit("")).alias(name) for c, name in ((role, "role"), (text, "text"))],
    )
    ordered = rows.repartition("conversation").sortWithinPartitions("conversation", "turn", "role", "text")
    turns = scratch.write(ordered.drop("turn").mapInPandas(_chain(tokenizer), _TURN), "turns")
    facts = ["parent", "depth", "role", "body", "n_tokens", "position", "loss_from", "loss_to"]
    nodes = scratch.write(turns.groupBy("node").agg(*[F.any_value(c).alias(c) for c in facts]), "nodes")

    # A conversation is named by its last node; its chain is kept once.
    chains = turns.groupBy("conversation").agg(F.max_by("node", "depth").alias("leaf"), F.count(F.lit(1)).alias("n_turns"))
    chains = scratch.write(chains, "chains")
    one = chains.groupBy("leaf").agg(F.min("conversation").alias("conversation"))
    steps = turns.select("conversation", F.struct("depth", "node").alias("step")).join(one, "conversation")
    paths = steps.groupBy("leaf").agg(F.array_sort(F.collect_list("step")).alias("steps"))
    paths = paths.select("leaf", F.transform("steps", lambda s: s["node"]).alias("nodes")).orderBy("nodes")
    paths = scratch.write(paths.select("leaf", "nodes", F.monotonically_increasing_id().alias("rank")), "paths")

    # The first conversation with a node, in this order, is the one that emits it.
    on_path = paths.select("rank", F.posexplode("nodes").alias("depth", "node"))
    first = on_path.groupBy("node").agg(F.min("rank").alias("rank"))
    first = first.join(nodes.select("node", "depth", "n_tokens"), "node")
    before = F.sum("n_tokens").over(Window.partitionBy("rank").orderBy("depth")) - F.col("n_tokens")
    first = scratch.write(first.withColumn("within", before), "first")
    part = F.shiftright("rank", 33)
    emitted = first.groupBy("rank").agg(F.sum("n_tokens").alias("n")).withColumn("part", part)
    of_part = emitted.groupBy("part").agg(F.sum("n").alias("n"))
    # A row per range partition of the sort above.
    part_start = of_part.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    in_part = F.sum("n").over(Window.partitionBy("part").orderBy("rank")) - F.col("n")
    path_start = emitted.withColumn("in_part", in_part).join(F.broadcast(part_start), "part")
    path_start = path_start.select("rank", (F.col("in_part") + F.col("part_start")).alias("path_start"))
    starts = first.join(path_start, "rank").select("node", "rank", (F.col("path_start") + F.col("within")).alias("start"), "n_tokens")
    starts = scratch.write(starts, "starts")

    # Chains again, with the starts of all their nodes.
    placed = on_path.join(starts.withColumnRenamed("rank", "first_rank"), "node")
    step = F.struct("depth", "node", "start", "n_tokens", (F.col("first_rank") == F.col("rank")).alias("is_first"))
    placed = placed.groupBy("rank").agg(F.array_sort(F.collect_list(step)).alias("path"))
    kind = "node binary, tree binary, ancestors array<struct<`from`: long, `to`: long>>"
    spans = placed.select("path").mapInPandas(_ancestors, kind)
    whole = nodes.join(starts.select("node", "start"), "node").join(spans, "node")
    scratch.drop("turns", "first")
    return PrefixTree(whole, chains, paths.select("leaf", "nodes"))


def read_back(tree: PrefixTree) -> DataFrame:
    """A row per conversation (as text): formatted, roles, texts, loss (the unescaped text under the loss mask)."""
    steps = tree.paths.select("leaf", F.posexplode("nodes").alias("depth", "node"))
    bodies = tree.nodes.select("node", "body", "loss_from", "loss_to")
    parts = steps.join(bodies, "node").groupBy("leaf").agg(
        F.array_sort(F.collect_list(F.struct("depth", "body", "loss_from", "loss_to"))).alias("parts")
    )
    formatted = F.array_join(F.transform("parts", lambda p: p["body"]), "")
    under_mask = F.transform(
        F.filter("parts", lambda p: p["loss_from"].isNotNull()),
        lambda p: unescape(F.substring(p["body"], p["loss_from"] + 1, p["loss_to"] - p["loss_from"])),
    )
    read = parts.select("leaf", formatted.alias("formatted"), F.array_join(under_mask, "").alias("loss"))
    said = F.transform(
        F.filter(F.split("formatted", r"<\|im_end\|>\n"), lambda t: t != ""), lambda t: F.substr(t, F.lit(len(START) + 1))
    )
    read = read.withColumn("said", said)
    roles = F.transform("said", lambda t: unescape_role(F.substring_index(t, "\n", 1)))
    texts = F.transform("said", lambda t: unescape(F.substr(t, F.length(F.substring_index(t, "\n", 1)) + 2)))
    read = read.select("leaf", "formatted", "loss", roles.alias("roles"), texts.alias("texts"))
    return tree.chains.join(read, "leaf")
