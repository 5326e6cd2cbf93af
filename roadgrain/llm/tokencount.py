"""Token counts of whole texts under a byte-level BPE vocabulary, by a whole-token shortcut.

Before any text is read the driver proves three things about the vocabulary file: that it is of
the kind this method is right for (byte-level pieces, no normaliser, no prefix space, plain
merges), which vocabulary strings encode alone as one token, and on which characters the
library's own splitting agrees with the pattern used here. Tasks then cut texts into pre-tokens,
count 1 for each that is a proven string, merge only the others, and remember the merged ones in
bounded memory. Texts with characters outside the proof are given to the library whole.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from roadgrain.llm.common import free_name, in_arrow

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
#: Merged pre-tokens that a worker remembers, and the longest of them; the memory is emptied when full.
REMEMBERED, LONGEST = 600_000, 64
#: Code points that the proof covers: the basic plane and the pictographs. Others go to the library.
PROVEN_RANGES = ((0x0, 0xD800), (0xE000, 0x10000), (0x1F300, 0x1FB00))


def byte_letters() -> str:
    """The 256 characters that stand for bytes in a byte-level vocabulary: printable bytes for themselves,
    the others, in order, for U+0100 onwards."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return "".join(chr(b if b in shown else next(rest)) for b in range(256))


@dataclass(frozen=True)
class Proof:
    """What is known of a vocabulary before texts are read; bounded by the vocabulary, so it is sent to the tasks."""

    path: str
    pattern: str
    #: Texts of vocabulary entries that encode alone as exactly one token.
    whole: frozenset[str]
    #: Strings that the library takes out of texts before it splits them.
    special: tuple[str, ...]
    #: A pattern that finds a character outside the proof.
    unknown: str


def _splits_alike(tokenizer, pattern, text: str) -> bool:
    return [span for _, span in tokenizer.pre_tokenizer.pre_tokenize_str(text)] == [m.span() for m in pattern.finditer(text)]


def _unproven(tokenizer, pattern, points: list[int]) -> list[int]:
    """The code points before or behind which the library cuts differently than the pattern does."""
    text = "".join(f"\n{x}{chr(p)}{x}" for p in points for x in "a1! ")
    if not points or _splits_alike(tokenizer, pattern, text):
        return []
    if len(points) == 1:
        return points
    half = len(points) // 2
    return _unproven(tokenizer, pattern, points[:half]) + _unproven(tokenizer, pattern, points[half:])


@lru_cache(maxsize=4)
def prove(path: str, pattern: str | None = None) -> Proof:
    """Inspect the vocabulary file; raises ValueError if the shortcut would not be right for it."""
    import public_tokenizers
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        stored = json.load(file)
    splitter, model = stored.get("pre_tokenizer") or {}, stored["model"]
    plain = {"dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None}
    if (
        stored.get("normalizer") is not None
        or splitter.get("type") != "ByteLevel"
        or splitter.get("add_prefix_space")
        or not splitter.get("use_regex", True)
        or model.get("type") != "BPE"
        or any(model.get(k) not in (v, "") for k, v in plain.items())
    ):
        raise ValueError(f"{path} is not a plain byte-level BPE vocabulary.")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation(), tokenizer.no_padding()
    pattern = pattern or public_tokenizers.PATTERN
    cut = regex.compile(pattern)
    unproven = {p for a, b in PROVEN_RANGES for k in range(a, b, 4096) for p in _unproven(tokenizer, cut, list(range(k, min(b, k + 4096))))}
    runs = []
    for p in (p for a, b in PROVEN_RANGES for p in range(a, b) if p not in unproven):
        if runs and runs[-1][1] == p - 1:
            runs[-1][1] = p
        else:
            runs.append([p, p])
    unknown = "[^" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs) + "]"
    letter_byte = {c: b for b, c in enumerate(byte_letters())}
    texts = []
    for token in model["vocab"]:
        try:
            texts.append(bytes(letter_byte[c] for c in token).decode())
        except (KeyError, UnicodeDecodeError):
            continue
    alone = tokenizer.encode_batch(texts, add_special_tokens=False)
    whole = frozenset(t for t, e in zip(texts, alone) if len(e.ids) == 1 and len(cut.findall(t)) == 1)
    return Proof(path, pattern, whole, tuple(t["content"] for t in stored.get("added_tokens", [])), unknown)


class Counter(dict):
    """Tokens of pre-tokens: 1 for the proven ones, merged and remembered for the rest."""

    def __init__(self, proof: Proof):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(proof.path)
        self.tokenizer.no_truncation(), self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.cut = regex.compile(proof.pattern).findall
        self.special = proof.special
        self.unknown = regex.compile(proof.unknown).search
        self.letters = dict(enumerate(byte_letters()))
        self.whole = dict.fromkeys(proof.whole, 1)
        self.update(self.whole)

    def __missing__(self, piece: str) -> int:
        n = len(self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters)))
        if len(piece) <= LONGEST:
            self[piece] = n
        return n

    def foreign(self, text: str) -> bool:
        """Whether the text must be left to the library."""
        return any(s in text for s in self.special) or not text.isascii() and self.unknown(text) is not None

    def count(self, text: str) -> int:
        if self.foreign(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if len(self) > len(self.whole) + REMEMBERED:
            self.clear()
            self.update(self.whole)
        return sum(map(self.__getitem__, self.cut(text)))


_counters: dict[Proof, Counter] = {}


def counted(
    documents: DataFrame, vocabulary: str | None = None, limit: int = LIMIT, proof: Proof | None = None
) -> DataFrame:
    """All columns and n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of the whole text.

    A null or empty text has 0 bytes and 0 tokens. Every row gets its own row, so repeated ids or
    rows stay; an empty table gives no rows. Other columns, of any type, are passed through; where
    the table already has a column of a new name, the new one gets a trailing underscore. Special
    strings of the vocabulary inside a text count as the library counts them. A text of any length
    is counted whole; one text is held in memory at a time besides its Arrow batch.
    """
    import public_tokenizers

    proof = proof or prove(vocabulary or public_tokenizers.path(VOCABULARY))
    names = [free_name(documents, wanted) for wanted in ("n_bytes", "n_tokens", "over_limit")]
    at, given = documents.columns.index("text"), list(documents.columns)

    def count(batches):
        if proof not in _counters:
            _counters[proof] = Counter(proof)
        counter = _counters[proof]
        for rows in batches:
            sizes, tokens = [], []
            for value in rows.column(at):
                text = value.as_py() or ""
                sizes.append(len(text) if text.isascii() else len(text.encode()))
                tokens.append(counter.count(text))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())], names=[*given, *names[:2]]
            )

    schema = StructType([*documents.schema.fields, *[StructField(n, LongType()) for n in names[:2]]])
    return in_arrow(documents, count, schema).withColumn(names[2], F.col(names[1]) > limit)
