"""Chat formatting: reply trees to conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewell.llm.common import saved

CONTROL = r"\\|<(?=[|/s])|\[(?=/?INST\])"


def escape(text: str) -> str:
    """No control string of the template, nor a common one of others, is left; reversible."""
    import re

    return re.sub(CONTROL, lambda found: "\\\\" if found[0] == "\\" else found[0] + "\\", text)


def unescape(text: str) -> str:
    import re

    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation as one text, and the spans of the assistant's texts, which bear the loss."""
    out, size, spans = [], 0, []
    for role, text in turns:
        head = f"<|{escape(role).replace('|', '\\|').replace('>', '\\>')}|>\n"
        body = escape(text)
        if role == "assistant":
            spans.append((size + len(head), size + len(head) + len(body)))
        out += [head, body, "</s>\n"]
        size += len(head) + len(body) + 5
    return "".join(out), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns that ``format_turns`` was given."""
    import re

    turns = re.finditer(r"<\|((?:[^\\|]|\\.)*)\|>\n(.*?)</s>\n", formatted, flags=re.DOTALL)
    return [(unescape(turn[1]), unescape(turn[2])) for turn in turns]


def paths(nodes: DataFrame) -> DataFrame:
    """``(conv_id, leaf, node, back)``: every node on the way from each leaf to its root.

    ``nodes`` has ``conv_id, node, parent`` (null at roots). Step i joins what is reached so far with
    the table of 2^i-fold ancestors, and that table with itself, so that a path of n turns takes
    about log2(n) joins. Each step is written.
    """
    up = nodes.where(F.col("parent").isNotNull())
    jumps = up.select("conv_id", F.col("node").alias("at"), F.col("parent").alias("to"))
    jumps = saved(jumps.join(nodes.select("conv_id", F.col("node").alias("to")), ["conv_id", "to"], "left_semi"), "jumps")
    parents = jumps.select("conv_id", F.col("to").alias("node")).distinct()
    leaves = nodes.join(parents, ["conv_id", "node"], "left_anti")
    reached = leaves.select("conv_id", F.col("node").alias("leaf"), F.col("node").alias("at"), F.lit(0).alias("back"))
    step, most = 1, max(nodes.count(), 1)
    while not jumps.isEmpty():
        if step > most:
            raise ValueError("replies form a circle")
        further = reached.join(jumps, ["conv_id", "at"])
        further = further.select("conv_id", "leaf", F.col("to").alias("at"), (F.col("back") + step).alias("back"))
        reached = saved(reached.unionByName(further), "reached")
        second = jumps.select("conv_id", F.col("at").alias("to"), F.col("to").alias("end"))
        jumps = saved(jumps.join(second, ["conv_id", "to"]).select("conv_id", "at", F.col("end").alias("to")), "jumps")
        step *= 2
    return reached.withColumnRenamed("at", "node")


def conversations(messages: DataFrame, keep: int = 1) -> DataFrame:
    """The ``keep`` best branches of each reply tree, each as one conversation:
    ``(conv_id, branch, n_turns, formatted, loss)``.

    ``messages`` has ``conv_id, node, parent, role, text, score``; ``node`` is unique in a tree. A
    branch runs from a root to a leaf; branches are ranked by the mean score of their messages (null
    counts as 0), ties to the smaller leaf, and ``branch`` is that rank from 1. A message whose parent
    is missing starts a tree of its own. Null roles and texts count as empty; messages without a
    conversation id form one; columns other than these are ignored. An empty table gives none.

    Turns are sorted by path within a partition and formatted as a stream: one conversation at a
    time is in memory, however many messages a task has.
    """
    facts = messages.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv_id"),
        F.col("conv_id").cast("string").alias("shown"),
        "node",
        "parent",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
    )
    kind = dict(messages.dtypes)["conv_id"]
    facts = saved(facts, "messages")
    found = paths(facts.select("conv_id", "node", "parent"))
    scored = found.join(facts.select("conv_id", "node", "score"), ["conv_id", "node"])
    branches = scored.groupBy("conv_id", "leaf").agg(F.avg("score").alias("mean"))
    rank = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.desc("mean"), "leaf"))
    chosen = branches.withColumn("branch", rank).where(F.col("branch") <= keep).select("conv_id", "leaf", "branch")
    turns = found.join(chosen, ["conv_id", "leaf"]).join(facts.drop("score"), ["conv_id", "node"])
    turns = turns.select("conv_id", "shown", "branch", "back", "role", "text")
    turns = turns.repartition("conv_id", "branch").sortWithinPartitions("conv_id", "branch", F.desc("back"))

    def run(batches):
        import pandas as pd

        def row(key, turns):
            formatted, spans = format_turns(turns)
            return key[1], key[2], len(turns), formatted, [list(span) for span in spans]

        def frame(rows):
            return pd.DataFrame(rows, columns=["conv_id", "branch", "n_turns", "formatted", "loss"])

        last, turns = None, []
        for batch in batches:
            done = []
            for conv_id, shown, branch, role, text in zip(*(batch[c] for c in ("conv_id", "shown", "branch", "role", "text"))):
                if last is not None and (conv_id, branch) != (last[0], last[2]):
                    done.append(row(last, turns))
                    turns = []
                last = (conv_id, shown, branch)
                turns.append((role, text))
            yield frame(done)
        if last is not None:
            yield frame([row(last, turns)])

    schema = "conv_id string, branch int, n_turns bigint, formatted string, loss array<array<bigint>>"
    return turns.mapInPandas(run, schema).withColumn("conv_id", F.col("conv_id").cast(kind))


def thread(rows: DataFrame) -> DataFrame:
    """Plain conversations as reply trees: each row answers the one before it by turn. Rows of one turn
    follow by role and text; repeated rows stay separate."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.select("conv_id", "role", "text", F.row_number().over(order).cast("bigint").alias("node"))
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    return rows.withColumns({"parent": parent, "score": F.lit(0.0)})


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted texts say when read back: ``(conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars)``."""

    def run(batches):
        import hashlib

        import pyarrow as pa

        def digest(text):
            return hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()

        for batch in batches:
            out = []
            for text, loss in zip(batch.column("formatted").to_pylist(), batch.column("loss").to_pylist()):
                turns = read_turns(text)
                said = "".join(unescape(text[start:stop]) for start, stop in loss)
                whole = "".join(f"{role}\n{words}\n" for role, words in turns)
                out.append((len(turns), digest(whole), len(said), digest(said), len(text)))
            names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = [pa.array([row[i] for row in out], kind) for i, kind in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *columns], ["conv_id", *names])

    rows = formatted.select("conv_id", "formatted", "loss")
    schema = (
        f"conv_id {dict(rows.dtypes)['conv_id']}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint"
    )
    return rows.mapInArrow(run, schema)
