"""Token counts by the whole-token shortcut.

The vocabulary is proved once per worker: a vocabulary string is *whole* when
the tokenizer encodes it alone as exactly one token.  A text is cut into
pre-tokens by the tokenizer's own split pattern; whole ones count one without
any merging, and only the rest go through the merges (their counts are kept
in a bounded memo).  Texts with characters beyond Latin, where Unicode tables
of two libraries could differ, are counted by the tokenizer itself.

Null counts as the empty text (0 tokens).  Special strings inside a text are
one token each, as the tokenizer's default has it.  Rows are independent:
repeated rows and ties give the same numbers; an empty table gives no rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from measures.llm.common import ship_package

MEMO_ENTRIES = 1_000_000
MEMO_CHARS = 64
LIST_CHARS = 1 << 20
LATIN_END = 0x250


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def latin_split() -> re.Pattern:
    """The split pattern for texts below U+0250, for the standard `re`, which
    has no Unicode properties but is more than twice as fast."""
    def chars(test) -> str:
        return "".join(re.escape(c) for c in map(chr, range(LATIN_END)) if test(c))

    letter = chars(lambda c: unicodedata.category(c)[0] == "L")
    number = chars(lambda c: unicodedata.category(c)[0] == "N")
    space = re.escape(" \t\n\x0b\x0c\r\x85\xa0")
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+"
                      rf"| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+")


class PreTokenCosts(dict):
    """Pre-token -> number of tokens; starts with the proved whole tokens."""

    def __init__(self, tokenizer, whole: list[str]):
        super().__init__(dict.fromkeys(whole, 1))
        self.tokenizer, self.whole = tokenizer, whole

    def __missing__(self, piece: str) -> int:
        n = len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        if len(piece) <= MEMO_CHARS:
            if len(self) > len(self.whole) + MEMO_ENTRIES:
                self.clear()
                self.update(dict.fromkeys(self.whole, 1))
            self[piece] = n
        return n


def prove_whole(tokenizer, split) -> list[str]:
    """Vocabulary strings that are one pre-token and encode alone as themselves."""
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    strings = {s: i for i in range(tokenizer.get_vocab_size())
               if (s := tokenizer.decode([i], skip_special_tokens=False)) and "�" not in s}
    names = [s for s in strings if s not in special and max(s) < chr(LATIN_END)
             and split.findall(s) == [s]]
    coded = tokenizer.encode_batch(names, add_special_tokens=False)
    return [s for s, e in zip(names, coded, strict=True) if len(e.ids) == 1]


class Counter:
    """Counts tokens of texts with one tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.split = latin_split()
        self.beyond = re.compile(f"[^\\x00-{chr(LATIN_END - 1)}]")
        special = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()),
                         key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.costs = PreTokenCosts(self.tokenizer, prove_whole(self.tokenizer, self.split))

    def count(self, text: str) -> int:
        if not text.isascii() and self.beyond.search(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if self.special is not None and (found := self.special.findall(text)):
            return len(found) + sum(map(self._plain, self.special.split(text)))
        return self._plain(text)

    def _plain(self, text: str) -> int:
        cost = self.costs.__getitem__
        if len(text) > LIST_CHARS:  # no list of all pieces of a very long text
            return sum(cost(m.group()) for m in self.split.finditer(text))
        return sum(map(cost, self.split.findall(text)))


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 path: str | None = None, limit: int = 1024) -> DataFrame:
    """Per row: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    `path` is the tokenizer file on the executors; by default the installed
    byte-level BPE vocabulary.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path or vocabulary_path()).count
        for b in batches:
            tokens = [count(t.as_py()) if t.is_valid else 0 for t in b.column("text")]
            yield pa.record_batch([b.column("id"), b.column("n_bytes"),
                                   pa.array(tokens, pa.int64())],
                                  names=["id", "n_bytes", "n_tokens"])

    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"),
                       F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("bigint")
                       .alias("n_bytes"),
                       F.col(text_col).cast("string").alias("text"))
    return (rows.mapInArrow(run, "id bigint, n_bytes bigint, n_tokens bigint")
            .withColumn("over_limit", F.col("n_tokens") > limit))
