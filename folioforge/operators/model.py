"""The boundary to language and vision models: one call for each row, behind one interface.

The engine ships a deterministic stand-in that needs no network. Retries, fallback and the
classification of failures live here; usage comes out as rows and is never summed up in
driver state.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPLY = "request_id bigint, reply string, prompt_tokens bigint, completion_tokens bigint, attempts int, error string"


class ModelClient(Protocol):
    def complete(self, prompt: str) -> str:
        """The reply to a prompt; any exception is a failed attempt."""


class RuleClient:
    """The stand-in: splits text into a legends and an availability section by headings."""

    def complete(self, prompt: str) -> str:
        import json

        m = re.search(r"(?is)\bdata availability\b[:.\s]*(.*)", prompt)
        legends = prompt[: m.start()] if m else prompt
        return json.dumps({"figure_legends": legends.strip(), "data_availability": m[1].strip() if m else ""})


def waits(attempts: int, least: float = 1.0, most: float = 8.0) -> list[float]:
    """Seconds before each further attempt, doubling up to a cap."""
    return [min(most, least * 2**k) for k in range(attempts - 1)]


def complete_all(requests: DataFrame, id_col: str, prompt: str, make_client: Callable[[], ModelClient] = RuleClient, fallback: Callable[[], ModelClient] | None = None, attempts: int = 3, wait: float = 1.0) -> DataFrame:
    """A reply for each request; one client a task. Null and empty prompts are not sent and get
    a null reply without error; after the last attempt the fallback client is asked once."""

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for b in batches:
            rows = []
            for i, p in zip(b["request_id"], b["prompt"]):
                rows.append((i, *_ask(client, fallback, p, attempts, wait)))
            yield pd.DataFrame(rows, columns=["request_id", "reply", "prompt_tokens", "completion_tokens", "attempts", "error"])

    asked = requests.select(F.col(id_col).cast("bigint").alias("request_id"), F.col(prompt).alias("prompt"))
    return asked.mapInPandas(call, REPLY)


def _ask(client: ModelClient, fallback: Callable[[], ModelClient] | None, prompt: str | None, attempts: int, wait: float) -> tuple:
    if not prompt:
        return None, 0, 0, 0, None
    pauses, error = [0.0, *waits(attempts, wait)], None
    for k, pause in enumerate(pauses, 1):
        if pause and k > 1:
            time.sleep(pause)
        try:
            reply = client.complete(prompt)
            return reply, len(prompt) // 4, len(reply) // 4, k, None
        except Exception as e:  # noqa: BLE001  any failure of a client is an attempt
            error = f"{type(e).__name__}: {e}"
    if fallback is not None:
        try:
            reply = fallback().complete(prompt)
            return reply, len(prompt) // 4, len(reply) // 4, attempts + 1, None
        except Exception as e:  # noqa: BLE001
            error = f"{type(e).__name__}: {e}"
    return None, len(prompt) // 4, 0, attempts, error
