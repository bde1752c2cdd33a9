r"""Public tokenizers inside tasks, and their word splits outside them.

A byte-level BPE tokenizer first cuts a text into *words* (pre-tokens) with one
regular expression and then splits each word for itself.  ``split_words`` runs
that expression in the JVM.  Letters, numbers and blanks are the same there as in
the tokenizer's own expression for every code point that the JVM knows; texts
with a code point that it does not know (``\p{Cn}``) are cut by the tokenizer
itself, in the task (``word_lists``).
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"

#: White space of the tokenizer's expression.  Fixed values.
BLANK = r"\t-\r\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
#: The tokenizer's expression for words, with its white space spelled out.
WORDS = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + BLANK + r"\p{L}\p{N}]+|[" + BLANK + r"]+(?![^" + BLANK + r"])|["
         + BLANK + "]+")
#: Code points that the JVM does not know.
UNKNOWN = r"\p{Cn}"


def place(name: str) -> str:
    """Where a vocabulary file lies: a path as it is, or the name of a public tokenizer."""
    if "/" in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def byte_tokenizer(name: str):
    """Special strings inside texts are plain text to it."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(place(name))
    tokenizer.encode_special_tokens = True
    return tokenizer


@lru_cache(maxsize=4)
def piece_tokenizer(name: str):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=place(name))


@lru_cache(maxsize=4)
def special_strings(name: str) -> tuple[str, ...]:
    return tuple(t.content for t in byte_tokenizer(name).get_added_tokens_decoder().values() if t.special)


def split_words(text: Column, plain: Column) -> Column:
    """Words of a text; null where ``plain`` is not true, for ``word_lists`` to cut."""
    return F.when(plain, F.regexp_extract_all(text, F.lit(WORDS), F.lit(0)))


def own_words(tokenizer, text: str) -> list[str]:
    return [text[a:z] for _, (a, z) in tokenizer.pre_tokenizer.pre_tokenize_str(text)]


def word_lists(words: pa.ListArray, others: dict[int, list[str]]) -> tuple[pa.Array, np.ndarray]:
    """All words in the order of the rows, and the row of each; ``others`` has the words of rows without a list."""
    sizes = np.asarray(pc.fill_null(pc.list_value_length(words), 0)).astype(np.int64)
    flat, owner = words.flatten(), np.repeat(np.arange(len(words)), sizes)
    if others:
        flat = pa.concat_arrays([flat, *(pa.array(x, flat.type) for x in others.values())])
        owner = np.concatenate([owner, *(np.full(len(x), row) for row, x in others.items())])
        order = np.argsort(owner, kind="stable")
        flat, owner = flat.take(pa.array(order)), owner[order]
    return flat, owner


def utf8_parts(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array."""
    strings = strings.cast(pa.large_binary())
    n = len(strings)
    if not n:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    offsets = np.frombuffer(strings.buffers()[1], dtype=np.int64)[strings.offset:strings.offset + n + 1]
    data = np.frombuffer(strings.buffers()[2] or b"", dtype=np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]
