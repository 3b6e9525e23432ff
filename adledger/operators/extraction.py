"""Field extraction from listing texts: by native rules, or by a caller's function."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.listing import DEFAULT_IMAGE_HOST, listing_fields
from ..functions.records import parse_llm_json
from ..functions.text import clean_listing_text, has_text, text_len
from ..schemas import EXTRACTED_FIELDS

ANSWER = T.StructType([T.StructField("answer", T.StringType()), T.StructField("error", T.StringType())])

# Bounded retries of a transient failure, seconds.
ATTEMPTS, FIRST_WAIT, LONGEST_WAIT = 3, 5.0, 30.0

#: Clients of different calls that a worker process holds at once; the oldest goes first.
CLIENTS = 4


class TransientError(Exception):
    """Raise this from an extraction function to be called again."""


def parse_listing(df: DataFrame, text: str = "text", host: str = DEFAULT_IMAGE_HOST) -> DataFrame:
    """All vehicle fields of each text, beside the other columns. One projection."""
    return df.select(*[c for c in df.columns if c != text], *listing_fields(text, host))


def llm_extract(
    df: DataFrame, fn: Callable[[str], str | dict] | None, text: str = "raw_text",
    fields: Sequence[str] = tuple(EXTRACTED_FIELDS), attempts: int = ATTEMPTS, wait: float = FIRST_WAIT,
    setup: Callable[[], Callable[[str], str | dict]] | None = None,
) -> DataFrame:
    """Fields answered by ``fn`` for each text, normalised; a failure fills ``error`` only.

    ``fn`` maps a text to a JSON object (text or dict) and is shipped to the
    executors, where it runs batch by batch. Rows whose text is NULL are not sent.
    ``setup``, given instead of ``fn``, is called once per worker process before its first text and
    returns the function: the place to load a model or open a client. Later tasks of the worker
    use it again; one that failed to load is tried anew with the next text.
    """
    if (fn is None) == (setup is None):
        raise ValueError("give either fn or setup")
    call = uuid.uuid4().hex  # names this call's client among those a worker holds

    def client() -> Callable[[str], str | dict]:
        import sys

        held = sys.__dict__.setdefault("_adledger_client", {})  # the one place all tasks of a worker share
        if call not in held:
            made = setup()
            if len(held) >= CLIENTS:
                held.pop(next(iter(held)))
            held[call] = made
        return held[call]

    def ask(body: str) -> tuple[str | None, str | None]:
        for attempt in range(attempts):
            try:
                answer = (fn or client())(body)
                parsed = json.loads(answer) if isinstance(answer, str) else answer
                if not isinstance(parsed, dict):
                    raise ValueError("answer is no JSON object")
                return json.dumps(parsed), None
            except TransientError as e:
                if attempt == attempts - 1:
                    return None, f"{type(e).__name__}: {e}"
                time.sleep(min(LONGEST_WAIT, wait * 2 ** attempt))
            except Exception as e:
                return None, f"{type(e).__name__}: {e}"
        return None, "not attempted"

    @F.pandas_udf(ANSWER)
    def answer_batch(bodies: pd.Series) -> pd.DataFrame:
        rows = [ask(b) if b is not None else (None, None) for b in bodies]
        return pd.DataFrame(rows, columns=["answer", "error"], dtype=object)

    asked = df.withColumn("_reply", answer_batch(F.col(text)))
    record = parse_llm_json(F.col("_reply.answer"), list(fields))
    earlier = F.col("error") if "error" in df.columns else F.lit(None).cast("string")
    kept = [c for c in df.columns if c != "error" and c not in fields]
    return asked.withColumn("_rec", record).select(
        *kept, *[F.col("_rec")[f].alias(f) for f in fields],
        F.coalesce(earlier, F.col("_reply.error")).alias("error"))


def with_model_text(df: DataFrame, raw: str = "raw_text") -> DataFrame:
    """Cleaned modeling text, its length and its flag."""
    return df.withColumn("combined_text", clean_listing_text(raw)).withColumns({
        "combined_text_len": text_len("combined_text"), "has_combined_text": has_text("combined_text")})
