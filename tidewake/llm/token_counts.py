"""Token counts by the whole-token shortcut.

A BPE with word ends cuts a text into pre-tokens and merges each for itself. It
is proven once, on the driver, which vocabulary strings come out as one token
when they are encoded alone. Pre-tokens found in that list count one without
being merged; only the rest goes through the tokenizer, each distinct one once
in a while. Whole words are remembered with their counts.

The shortcut covers texts in code points for which the cutting rule below and
the library are known to agree (a test goes through all of them). Texts with
others, or with special strings, are encoded whole by the library itself.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewake.llm.common import slices, text_of

# Code points that the shortcut covers: up to here, also in lower case, without
# the separators that Python alone takes for white space.
COVERED = 0x250
UNCOVERED = re.compile("[\x1c-\x1f]")

# Distinct words remembered in a worker; a full memory starts anew.
MEMORY = 400_000


def _char_class(categories: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(COVERED) if unicodedata.category(chr(c))[0] in categories)


def cutting_rule() -> re.Pattern:
    """Pre-tokens of a word in lower case: contractions, letters, single digits, other signs."""
    letters, digits = _char_class("L"), _char_class("N")
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^\\s{letters}{digits}]+")


def whole_tokens(tokenizer_path: str) -> list[str]:
    """Vocabulary strings that encode alone as one token."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)
    end = json.loads(tokenizer.to_str())["model"]["end_of_word_suffix"]
    # The printable stand-ins of bytes: fixed values of the byte-level format.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(shown)))}
    texts = []
    for entry in tokenizer.get_vocab(with_added_tokens=False):
        if entry.endswith(end):
            try:
                texts.append(bytes(byte_of[c] for c in entry[: -len(end)]).decode())
            except UnicodeDecodeError:
                continue
    rule = cutting_rule()
    alone = tokenizer.encode_batch(texts, add_special_tokens=False)
    return [t for t, e in zip(texts, alone) if len(e.ids) == 1 and rule.fullmatch(t) and rule.findall(t) == [t]]


class Counter:
    """Tokens of a text."""

    def __init__(self, tokenizer_path: str, whole: list[str]):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        spec = json.loads(self.tokenizer.to_str())
        end = spec["model"]["end_of_word_suffix"]
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)")
        self.ends = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True) + 1, bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.ends[i] = token.endswith(end)
        self.whole, self.rule, self.memory = frozenset(whole), cutting_rule(), {}

    def _merged(self, pieces: list[str]) -> dict[str, int]:
        """Counts of pre-tokens that need merging; each ends with a token that ends a word."""
        if not pieces:
            return {}
        ids = self.tokenizer.encode(" ".join(pieces), add_special_tokens=False).ids
        ends = np.flatnonzero(self.ends[np.array(ids)])
        if len(ends) != len(pieces):
            raise ValueError("pre-tokens do not stand alone")
        return dict(zip(pieces, np.diff(ends, prepend=-1).tolist()))

    def _learn(self, words: set[str]) -> None:
        cut = {w: self.rule.findall(w) for w in words}
        merged = self._merged(list({p for ps in cut.values() for p in ps} - self.whole))
        for w, ps in cut.items():
            self.memory[w] = sum(merged.get(p, 1) for p in ps)

    def counts(self, texts: list[str]) -> list[int]:
        if len(self.memory) > MEMORY:
            self.memory.clear()
        out, words = [0] * len(texts), {}
        for i, text in enumerate(texts):
            lower = text.lower()
            covered = text.isascii() or max(ord(max(text)), ord(max(lower))) < COVERED
            if covered and not UNCOVERED.search(text) and not ("<|" in text and self.special.search(text)):
                words[i] = lower.split()
            else:
                out[i] = len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        self._learn({w for ws in words.values() for w in ws if w not in self.memory})
        for i, ws in words.items():
            out[i] = sum(map(self.memory.__getitem__, ws))
        return out


def count_tokens(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048,
) -> DataFrame:
    """One row per document: id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than ``limit`` tokens).

    A null text is empty and has no tokens. Every row is counted for itself, so
    repeated rows are repeated; other columns are ignored; an empty table gives
    no rows. Nothing is shuffled.
    """
    whole = whole_tokens(tokenizer_path)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    schema = T.StructType([
        T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
    ])

    def run(batches):
        counter = Counter(tokenizer_path, whole)
        for large in batches:
            for batch in slices(large, "text"):
                texts = batch.column("text")
                sizes = pc.binary_length(texts).cast(pa.int64())
                counts = pa.array(counter.counts(texts.to_pylist()), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sizes, counts], names=schema.names)

    counted = rows.mapInArrow(run, schema)
    return counted.select(F.col("doc_id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
