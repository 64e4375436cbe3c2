"""SentencePiece encoding and decoding over a table of distinct marked words.

No piece of the models this serves holds a whitespace marker behind another character,
so no merge crosses from one word into the marker of the next, and a text is the
sequence of its marked words (leading markers plus what follows up to the next marker).
Each task keeps a table of the distinct marked words it has met, segments every new one once
with the library, and puts a text's ids together by looking its words up in order. A model
whose pieces do cross markers is refused.

The table belongs to one Python worker, so a word is segmented once in each worker that meets
it; it holds at most TABLE_WORDS words and starts anew when it is full, so memory does not
depend on the input. No rows move: there is no
shuffle, and a lost executor's part is simply computed again.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.llm.registry import query, table

TABLE_WORDS = 400_000
TABLE_BYTES = 48 << 20
_WORD = re.compile("[ ▁]*[^ ▁]+|[ ▁]+")
_CROSSING = re.compile("[^▁]▁")
_LOADED: dict[str, Segmenter] = {}  # one for each worker and model


class Segmenter:
    """A model with its table from marked words to ids (as bytes of int32)."""

    def __init__(self, model: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = map(self.model.id_to_piece, range(self.model.vocab_size()))
        if any(_CROSSING.search(p) for p in pieces):
            raise ValueError(f"{model} has pieces that cross whitespace markers")
        self.words: dict[str, bytes] = {}
        self.size = 0

    @classmethod
    def of(cls, model: str) -> Segmenter:
        if model not in _LOADED:
            _LOADED[model] = cls(model)
        return _LOADED[model]

    def encode(self, text: str) -> bytes:
        """Ids of a text as bytes of int32; none for an empty text."""
        if not text:
            return b""
        words = _WORD.findall(" " + text)  # the library puts a marker in front, too
        try:
            return b"".join([self.words[w] for w in words])
        except KeyError:
            if self.size > TABLE_BYTES or len(self.words) > TABLE_WORDS:
                self.words, self.size = {}, 0
            # behind a text's last word one marker may stand alone: the library has no text for it
            for lone in " ▁":
                self.words.setdefault(lone, array("i", [self.model.piece_to_id("▁")]).tobytes())
            new = list({w for w in words if w not in self.words})
            for word, ids in zip(new, self.model.encode([w[1:] for w in new], num_threads=1)):
                self.words[word] = got = array("i", ids).tobytes()
                self.size += len(word) + len(got)
            return b"".join([self.words[w] for w in words])

    def decode(self, ids: list[int]) -> str:
        return self.model.decode(ids) if ids else ""


def _lists(parts: list[bytes]) -> pa.Array:
    offsets = [0]
    for part in parts:
        offsets.append(offsets[-1] + len(part) // 4)
    flat = pa.Array.from_buffers(pa.int32(), offsets[-1], [None, pa.py_buffer(b"".join(parts))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)


def encode(text: Column | str, model: str) -> Column:
    """Ids of a text: array<int>, empty for null and for empty texts."""

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        segmenter = Segmenter.of(model)
        for batch in batches:
            yield _lists([segmenter.encode(x.as_py() or "") for x in batch])

    return ids(text)


def decode(ids: Column | str, model: str) -> Column:
    """The text of ids by the library's decode; empty for null and for no ids."""

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        segmenter = Segmenter.of(model)
        for batch in batches:
            yield pa.array([segmenter.decode(x.as_py() or []) for x in batch], pa.string())

    return text(ids)


def round_trip(text: Column | str, model: str) -> Column:
    """Struct of `ids` and `decoded`, the ids decoded again, in one pass."""

    @F.arrow_udf("ids array<int>, decoded string")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        segmenter = Segmenter.of(model)
        for batch in batches:
            parts = [segmenter.encode(x.as_py() or "") for x in batch]
            lists = _lists(parts)
            decoded = pa.array([segmenter.decode(np.frombuffer(p, np.int32).tolist()) for p in parts], pa.string())
            yield pa.StructArray.from_arrays([lists, decoded], ["ids", "decoded"])

    return both(text)


def encoded(df: DataFrame, text_col: str, model: str) -> DataFrame:
    """df with `ids` and `decoded` for every row.

    Null and empty texts have no ids and decode to the empty text; texts of any length are
    encoded whole; repeated rows get equal results; an empty table stays empty. Columns of
    df called ids or decoded are replaced, all others stay.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c not in ("ids", "decoded")]
    both = df.select(*rest, round_trip(F.col(f"`{text_col}`"), model).alias("_both"))
    return both.select(*rest, F.col("_both.ids"), F.col("_both.decoded"))


@query("op9_pieces")
def op9(spark, sf_dir):
    """Every document encoded and decoded with the 32k piece model."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = encoded(docs, "text", public_tokenizers.path("piece_bpe_32k.model"))
    listed = F.translate(F.col("ids").cast("string"), "[] ", "")
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
