"""Model calls behind one interface, inside partitions, with retries and acceptance by column rules elsewhere."""

from __future__ import annotations

import random
import re
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import markdown as M
from textloom.operators.gates import MAX_DEGRADED, chunk_reason

ATTEMPTS, BASE_SECONDS, CAP_SECONDS = 5, 2.0, 60.0


class AccountFault(Exception):
    """Nothing will succeed until the account is put right: the whole run stops."""


class Rewriter(Protocol):
    def __call__(self, system: str, user: str, temperature: float) -> tuple[str, str]:
        """(text, finish reason)."""


def local_rewriter(system: str, user: str, temperature: float) -> tuple[str, str]:
    """Deterministic and without a network: turns the order of neighbouring sentences in each line."""

    def turn(line: str) -> str:
        if line.startswith(("#", "|", "-")):
            return line
        s = re.split(r"(?<=[.!?])\s+", line)
        return " ".join(x for k in range(0, len(s), 2) for x in reversed(s[k : k + 2]))

    return "\n".join(map(turn, user.split("\n"))), "stop"


def backoff(attempt: int, retry_after: float | None = None, rng: random.Random | None = None) -> float:
    """Seconds to wait: what the server asks for, else doubling to a cap, with jitter."""
    return retry_after if retry_after is not None else min(CAP_SECONDS, BASE_SECONDS * 2**attempt) * (0.5 + (rng or random).random() / 2)


def call_model(rows: DataFrame, model: Callable[[], Rewriter], user: str, system: str = "", temperature: float = 1.0, attempts: int = ATTEMPTS, wait: float = 1.0) -> DataFrame:
    """Adds out, finish and error. A failed item is a row with an error; a fault of the account fails the run."""
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rows.schema)}, out string, finish string, error string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = model()
        for pdf in batches:
            said = []
            for text in pdf[user]:
                for k in range(attempts):
                    try:
                        said.append((*ask(system, text, temperature * 0.8**k), None))
                        break
                    except AccountFault:
                        raise
                    except Exception as e:
                        if k + 1 == attempts:
                            said.append((None, None, f"{type(e).__name__}: {e}"))
                        else:
                            time.sleep(wait * backoff(k))
            yield pdf.assign(out=[x[0] for x in said], finish=[x[1] for x in said], error=[x[2] for x in said])

    return rows.mapInPandas(run, schema)


def paraphrase(articles: DataFrame, doc: str, body: str, model: Callable[[], Rewriter], system: str = "", limit: int = M.CHUNK_CHARS) -> DataFrame:
    """(doc, text, degraded, rejected): chunks reworded, tables as they are, a refused chunk as its source.

    An article of which over half of what was sent came back unusable is rejected. Requests are chunks,
    so long articles spread over tasks.
    """
    parts = articles.select(F.col(doc), F.posexplode(M.chunks(body, limit)).alias("k", "chunk"))
    before = F.lag("chunk").over(Window.partitionBy(doc).orderBy("k"))
    parts = parts.withColumn("context", M.chunk_context(before, F.col("chunk"))).withColumn("sent", ~M.is_table("chunk"))
    asked = F.when(F.col("context") != "", F.concat(F.lit("Context, not to be rewritten: "), "context", F.lit("\n\n"), "chunk")).otherwise(F.col("chunk"))
    said = call_model(parts.where("sent").withColumn("user", F.col("chunk")).withColumn("prompt", asked), model, "user", system)
    reason = F.coalesce(F.col("error"), chunk_reason("out", "chunk", F.col("finish")))
    done = said.select(doc, "k", "chunk", "sent", reason.alias("reason"), F.when(reason.isNull(), M.restore_heading(F.col("chunk"), F.col("out"))).otherwise(F.col("chunk")).alias("text"))
    tables = parts.where("not sent").select(doc, "k", "chunk", "sent", F.lit(None).cast("string").alias("reason"), F.col("chunk").alias("text"))
    failed = F.sum(F.when(F.col("reason").isNotNull(), F.char_length("chunk")).otherwise(0)) / F.greatest(F.sum(F.when(F.col("sent"), F.char_length("chunk")).otherwise(0)), F.lit(1))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "text"))), lambda x: x["text"]), "\n\n")
    whole = done.unionByName(tables).groupBy(doc).agg(text.alias("text"), F.count("reason").alias("degraded"), failed.alias("_share"))
    return whole.withColumn("rejected", F.col("_share") > MAX_DEGRADED).drop("_share")


def prompt(template: str, **columns: Column) -> Column:
    """A template with {name} places filled from columns."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[columns[p] if k % 2 else F.lit(p) for k, p in enumerate(parts)])


def distinct_calls(calls: DataFrame, arguments: list[str], answer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Each distinct set of arguments is answered once and joined back."""
    return calls.join(answer(calls.select(*arguments).distinct()), arguments, "left")


Tools = dict[str, Callable[[dict], str]]
TOOL_CHARS, ROUNDS = 7000, 6


def answer_loop(question: str, seed: str, decide: Callable[[list[dict]], dict], tools: Tools, rounds: int = ROUNDS) -> tuple[str, list[dict]]:
    """(answer, messages): tools are called by name until the model answers; in the last round it must.

    ``decide`` returns {"answer": text} or {"tool": name, "arguments": {...}}. Errors of tools become text.
    """
    messages = [{"role": "user", "content": question}] + ([{"role": "tool", "content": seed}] if seed else [])
    for k in range(rounds + 1):
        said = decide(messages + ([{"role": "system", "content": "Answer now."}] if k == rounds else []))
        if "answer" in said or k == rounds:
            return said.get("answer", ""), messages
        name = said.get("tool")
        try:
            result = tools[name](said.get("arguments") or {}) if name in tools else f"No tool is named {name!r}."
        except Exception as e:
            result = f"{name} failed: {e}"
        messages.append({"role": "tool", "name": name, "content": result[:TOOL_CHARS]})
    return "", messages
