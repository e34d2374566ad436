"""Model calls behind table contracts: text and vision models, taggers. A callable is injected; the defaults are
deterministic stand-ins without any network. JSON is dug out of what models say."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirefold.sources.loose_json import loads

_FENCE = re.compile(r"```(?:json)?\s*(.*?)```", re.S | re.I)


def _balanced(text: str, a: str, b: str) -> str | None:
    """The first stretch from a to its matching b, strings skipped."""
    at = text.find(a)
    while at >= 0:
        depth, i, quoted = 0, at, False
        while i < len(text):
            c = text[i]
            if quoted:
                if c == "\\":
                    i += 1
                elif c == '"':
                    quoted = False
            elif c == '"':
                quoted = True
            elif c == a:
                depth += 1
            elif c == b:
                depth -= 1
                if not depth:
                    return text[at : i + 1]
            i += 1
        at = text.find(a, at + 1)
    return None


def extract_json(text: str | None):
    """The JSON value in a model's answer: fenced, whole, the first balanced object or list, repaired at last; else None."""
    if not text:
        return None
    tries = [m.group(1) for m in _FENCE.finditer(text)] + [text, _balanced(text, "{", "}"), _balanced(text, "[", "]")]
    for t in tries:
        if t:
            try:
                return json.loads(t)
            except ValueError:
                continue
    for t in tries:
        if t and t.strip()[:1] in "{[" and (got := loads(t.strip())) is not None:
            return got
    return None


def stub_page_type(text: str) -> str:
    """Stand-in for a text model: no page is typed."""
    return "AMBIGUOUS"


def model_column(df: DataFrame, text: str, out: str, call: Callable[[str], str | None] = stub_page_type, limit: int = 3000) -> DataFrame:
    """df with what `call` says about the first `limit` characters of a text, as the model's contract has it; errors and nulls give null.

    Rows go through Arrow batches; the callable is sent to the workers and may keep what it loads."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("string")
    def ask(s):
        def one(t):
            try:
                return None if t is None else call(t)
            except Exception:  # noqa: BLE001  a failed call is a null, not a failed task
                return None

        return s.map(one)

    return df.withColumn(out, ask(F.substring(text, 1, limit)))


def resolve_open_pages(types: DataFrame, pages: DataFrame, call: Callable[[str], str | None] = stub_page_type) -> DataFrame:
    """Types with the open ones (null) asked of a model; only those pages' texts are sent."""
    open_ = types.filter("page_type is null").join(pages, ["doc", "page"])
    asked = model_column(open_, "page_text", "said", call).select("doc", "page", F.coalesce("said", F.lit("AMBIGUOUS")).alias("said"))
    return types.join(asked, ["doc", "page"], "left").select("doc", "page", F.coalesce("page_type", "said").alias("page_type"), F.when(F.col("page_type").isNull(), "model").otherwise("fast").alias("method"))


def answers(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, json: the JSON value in each answer, null where there is none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [extract_json(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([None if v is None else json.dumps(v, ensure_ascii=False) for v in got], pa.string())], names=[key, "json"])

    return df.select(F.col(key).cast("long").alias(key), text).mapInArrow(run, f"{key} long, json string")
