"""Vectorised helpers for what expressions can't say: canonical JSON and token counts."""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..frames import also, col, unused
from ..specs import TableSpec
from .scalars import class_namespace, is_uuid, uuid5

_TOKEN = re.compile(r"\w+|[^\w\s]")


def canonical_json(raw: Column, exclude: tuple[str, ...] = ()) -> Column:
    """JSON with sorted keys, ``", "`` and ``": "``, non-ASCII kept, some fields left out; broken JSON gives null."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        def one(text):
            if text is None:
                return None
            try:
                value = json.loads(text)
            except ValueError:
                return None
            if isinstance(value, dict):
                value = {k: v for k, v in value.items() if k not in exclude}
            return json.dumps(value, sort_keys=True, ensure_ascii=False)

        return s.map(one)

    return run(raw)


def count_words(texts: pd.Series) -> pd.Series:
    """Words and punctuation marks of each text."""
    return texts.map(lambda t: len(_TOKEN.findall(t)) if t else 0)


count_words.seam = 0


@lru_cache(maxsize=4)
def _encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """Made once in a task's worker."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class Encoded:
    """A counter of tokens by a file of ranks, as ``token_count``, ``chunk_documents`` and the others take one. The file must be there on every machine; null texts have 0 tokens, and the strings of special tokens are text.

    By the known pattern no token reaches over white space but for one blank before a word, and two line ends before a word
    are a token each.
    """

    def __init__(self, path: str, pattern: str):
        self.path, self.pattern = path, pattern
        self.seam = 2 if pattern == public_tokenizers.PATTERN else None

    def __call__(self, texts: pd.Series) -> pd.Series:
        encode = _encoding(self.path, self.pattern).encode_ordinary
        return pd.Series([len(encode(t)) if t else 0 for t in texts], index=texts.index, dtype="int64")


_ENCODINGS: dict[str, Encoded] = {}


def register_encoding(name: str, path: str, pattern: str) -> Encoded:
    """Names a file of ranks and its pattern; the counter of that name."""
    _ENCODINGS[name] = Encoded(path, pattern)
    return _ENCODINGS[name]


def encoding(name: str) -> Encoded:
    """The counter of a registered encoding; another name is an error."""
    if name not in _ENCODINGS:
        raise ValueError(f"no encoding is named {name}; register_encoding tells where its ranks are")
    return _ENCODINGS[name]


#: What Python takes for white space, and a token of ``count_words``, in Java's words.
_SPACE = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_JAVA_TOKEN = rf"[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{_SPACE}]"


def token_count(c: Column, counter: Callable[[pd.Series], pd.Series] = count_words) -> Column:
    """Tokens of each text by a counter: words and marks, or ``encoding(name)``.

    Words and marks are counted by a built-in expression; only texts with characters that Java's Unicode doesn't know go to
    Python, so that its memory doesn't grow with the texts.
    """

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return counter(texts).astype("int64")

    text = c.cast("string")
    if counter is not count_words:
        return run(text)
    newer = text.rlike(r"\p{Cn}")
    plain = F.coalesce(F.regexp_count(text, F.lit(_JAVA_TOKEN)), F.lit(0)).cast("long")
    return F.when(newer, run(F.when(newer, text))).otherwise(plain)


def fill_placeholder_ids(df: DataFrame, spec: TableSpec, raw: str = "raw") -> DataFrame:
    """Absent or malformed UUID fields get the UUID of the whole raw record and the field's name."""
    (seed,) = unused(df, "seed")
    fields = [n for n, (kind, _) in spec.columns.items() if kind == "uuid"]
    filled = {n: F.when(is_uuid(F.col(n)), F.col(n)).otherwise(uuid5(class_namespace(spec.name), F.concat(col(seed), F.lit(n)))) for n in fields if n in df.columns}
    return also(df, **{seed: canonical_json(col(raw))}).withColumns(filled).drop(seed)
