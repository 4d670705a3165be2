"""Batch model enrichment: one client per partition, Arrow batches in and out."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

Model = Callable[[pd.Series], pd.Series]


def batch_predict(df: DataFrame, prompt_col: str, model_factory: Callable[[], Model],
                  out_col: str = "response") -> DataFrame:
    """Append ``out_col`` = model(prompt) for every row (an iterator pandas UDF).

    ``model_factory`` runs once per task on the executor (open the client there, not on
    the driver); the model is called on whole Arrow batches. Only the prompt column goes to
    Python, so the other columns keep their values and types whatever pandas makes of them.
    """
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = model_factory()
        for b in batches:
            yield model(b)

    return df.withColumn(out_col, run(F.col(prompt_col)))


def _answers(model: Model, prompts: pd.Series, retries: int) -> pd.DataFrame:
    """``response, error`` per prompt: the whole batch at once, and one by one if it keeps failing."""
    def tried(part: pd.Series):
        for left in range(retries, -1, -1):
            try:
                return model(part), None
            except Exception as e:  # the model is foreign code: whatever it raises belongs to its prompt
                if not left:
                    return None, f"{type(e).__name__}: {e}"

    out, error = tried(prompts)
    if error is None:
        return pd.DataFrame({"response": list(out), "error": None})
    singles = [tried(prompts.iloc[i:i + 1]) for i in range(len(prompts))] if len(prompts) > 1 else [(out, error)]
    return pd.DataFrame({"response": [None if r is None else r.iloc[0] for r, _ in singles], "error": [e for _, e in singles]})


def predict_distinct(df: DataFrame, prompt_col: str, model_factory: Callable[[], Model], out_col: str = "response",
                     error_col: str = "error", retries: int = 2, batch_rows: int = 100) -> DataFrame:
    """Append ``out_col`` and ``error_col``: the model is called once per distinct prompt, not per row.

    Distinct prompts (collapsed map-side) are answered in batches of ``batch_rows`` and written once, so no join or later
    action calls the model again; the answers are joined back (AQE broadcasts them if they are few and splits a
    prompt that very many rows share). A batch that fails is tried ``retries`` more times and then prompt by
    prompt: a prompt that keeps failing gets the error's text and a NULL answer and takes no other row with it.
    A NULL prompt is not sent and gets NULL for both.
    """
    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = model_factory()
        for b in batches:
            for at in range(0, len(b), batch_rows):
                some = b["__prompt"].iloc[at:at + batch_rows].reset_index(drop=True)
                yield _answers(model, some, retries).assign(__prompt=some)[["__prompt", "response", "error"]]

    prompts = df.select(F.col(prompt_col).cast("string").alias("__prompt")).filter(F.col("__prompt").isNotNull()).distinct()
    answers = materialize(prompts.mapInPandas(answer, "__prompt string, response string, error string"), "model_answers")
    answers = answers.withColumnsRenamed({"response": "__response", "error": "__error"})
    return (df.join(answers, F.col(prompt_col).cast("string") == F.col("__prompt"), "left")
            .select(*[F.col(f"`{c}`") for c in df.columns], F.col("__response").alias(out_col), F.col("__error").alias(error_col)))


def echo_upper_model() -> Model:
    """Deterministic stand-in model for tests: the upper-cased prompt (NULL stays NULL)."""
    return lambda s: s.str.upper()
