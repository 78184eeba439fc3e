"""Token counts with a whole-token shortcut.

Which vocabulary strings encode alone as one token is proved once, offline, by encoding each of them. A pre-token that
is such a string counts one by a look-up; only the others are merged.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkmill.llm.common import table

#: The limit of the registered query.
LIMIT = 512

#: Code points whose class (letter, number, white space, other) every Unicode version since 3.2 agrees on, so that the
#: splitting here and the one inside the tokenizer's library agree too. Other texts go through the library whole.
SETTLED = (
    "\x00-Ƞɐ-ʭΐ-ΡΣ-ώЀ-ҁא-תء-غ‐-‧‰-⁆"
    "←-⇿─-◿ぁ-ゔァ-ヺ一-龥가-힣！-～"
)
#: The splitting of a byte-level vocabulary, as its file declares it by name only. Fixed value.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Texts are cut about this often (in characters), where a cut cannot change the pre-tokens.
SLAB = 1 << 20
#: Merged pre-tokens remembered by one Python worker; beyond that the memory starts anew.
REMEMBERED = 400_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_table() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary file: printable ones for themselves, the others
    in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def merge_ranks(spec: dict) -> dict[bytes, int] | None:
    """Byte strings and ranks of a plain byte-level BPE file whose merges stand in order of their results' ids.

    None if the file describes anything else; its texts are then left to the library.
    """
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or spec.get("normalizer") or model.get("dropout") or model.get("ignore_merges"):
        return None
    if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
        return None
    letters = byte_table()
    special = {t["content"] for t in spec.get("added_tokens", [])}
    vocab = {s: i for s, i in model["vocab"].items() if s not in special}
    if not all(c in letters for s in vocab for c in s):
        return None
    made = [vocab.get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    single = {s for s in vocab if len(s) == 1}
    if len(single) != 256 or None in made or made != sorted(made) or len(made) + 256 != len(vocab):
        return None
    return {bytes(letters[c] for c in s): i for s, i in vocab.items()}


def whole_tokens(spec: str) -> list[str] | None:
    """The proof: vocabulary strings that the library, given the string alone, encodes as exactly that one token."""
    from tokenizers import Tokenizer

    ranks = merge_ranks(json.loads(spec))
    if ranks is None:
        return None
    library = Tokenizer.from_str(spec)
    strings, ids = [], []
    for raw, rank in ranks.items():
        try:
            strings.append(raw.decode())
            ids.append(rank)
        except UnicodeDecodeError:
            pass  # part of a character; a pre-token never is
    encoded = library.encode_batch(strings, add_special_tokens=False)
    return [s for s, i, e in zip(strings, ids, encoded, strict=True) if e.ids == [i]]


class _Counts(dict):
    """Tokens of a pre-token: one for whole tokens, else merged when first met."""

    def __init__(self, whole: list[str], merge: Callable[[str], list[int]]):
        super().__init__(dict.fromkeys(whole, 1))
        self.whole, self.merge = whole, merge

    def __missing__(self, piece: str) -> int:
        if len(self) > len(self.whole) + REMEMBERED:
            self.clear()
            self.update(dict.fromkeys(self.whole, 1))
        n = self[piece] = len(self.merge(piece))
        return n


def slabs(text: str) -> Iterator[str]:
    """``text`` cut before single spaces between two other characters, where a pre-token begins in any case."""
    start, cut = 0, re.compile(r"(?<=\S) (?=\S)")
    while len(text) - start > SLAB:
        found = cut.search(text, start + SLAB)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def counter(spec: str, whole: list[str] | None) -> Callable[[str], int]:
    """A function from a text to its number of tokens, for one Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(spec)

    def by_library(text: str) -> int:
        return len(library.encode(text, add_special_tokens=False).ids)

    if whole is None:
        return by_library
    import regex
    import tiktoken

    parsed = json.loads(spec)
    special = [t["content"] for t in parsed.get("added_tokens", [])]
    bpe = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=merge_ranks(parsed), special_tokens={})
    counts, split = _Counts(whole, bpe.encode_ordinary), regex.compile(SPLIT).findall
    unsettled = re.compile(f"[^{SETTLED}]").search

    def count(text: str) -> int:
        if any(s in text for s in special) or not text.isascii() and unsettled(text):
            return by_library(text)
        return sum(sum(map(counts.__getitem__, split(slab))) for slab in slabs(text))

    return count


def piece_counter(model: bytes) -> Callable[[str], int]:
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    return lambda text: len(library.encode(text, num_threads=1))


def token_count(spark: SparkSession, text: Column, path: str | None = None) -> Column:
    """The number of tokens of a text column: whole texts, no special tokens added, null as empty.

    ``path`` names a ``.json`` file (special strings inside texts are handled as the library does by default) or a
    ``.model`` file on the driver; its bytes, which the vocabulary bounds, are broadcast.
    """
    path = path or default_tokenizer()
    with open(path, "rb") as file:
        raw = file.read()
    pieces = path.endswith(".model")
    shared = spark.sparkContext.broadcast((raw, None if pieces else whole_tokens(raw.decode())))

    def batches(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        raw, whole = shared.value
        count = piece_counter(raw) if pieces else counter(raw.decode(), whole)
        for part in parts:
            yield pd.Series([count(t) for t in part], dtype="int64")

    return F.pandas_udf(batches, T.LongType())(F.coalesce(text, F.lit("")))


def count_tokens(docs: DataFrame, text: str = "text", limit: int = LIMIT, path: str | None = None) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit``; columns of these names are replaced.

    Narrow: no shuffle, rows stay as they are, repeated ones too. Null and empty texts have 0 bytes and tokens.
    """
    own = ("n_bytes", "n_tokens", "over_limit")
    column = F.col(f"`{text}`")
    counted = docs.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in own],
        F.octet_length(F.coalesce(column, F.lit(""))).cast("long").alias("n_bytes"),
        token_count(docs.sparkSession, column, path).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs).select("doc_id", "n_bytes", "n_tokens", "over_limit")
