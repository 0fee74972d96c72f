"""Token counts (map-side two-tier lookup).

The first tier is a compact broadcast table from frequent pre-tokens to their lengths in tokens.  The frequent
pre-tokens are those that the tokenizer's own vocabulary stores whole, so the table has at most as many rows as
the vocabulary, whatever the corpus.  Misses are encoded once a worker and kept in its cache.  No pre-token is
ever shuffled: the only stage reads the texts and returns a row for each.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import whole_text
from tidemark.llm.tokens import ByteBpe, TextCoder, byte_alphabet
from tidemark.plans.runtime import map_arrow

#: Rows of a broadcast table at most; a larger vocabulary's table keeps its lowest ids, the most frequent pre-tokens.
TABLE_ROWS = 200_000

_coders: dict[str, TextCoder] = {}


def frequent_lengths(path: str, rows: int = TABLE_ROWS) -> dict[str, int]:
    """word → tokens of the chunk ``" word"``, for the vocabulary entries that are such chunks."""
    bpe, letters = ByteBpe.open(path), byte_alphabet()
    words = []
    for token, _ in sorted(bpe.vocab.items(), key=lambda x: x[1])[:rows]:
        try:
            chunk = bytes(letters[c] for c in token).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            continue
        if chunk[:1] == " " and chunk[1:] and not any(c.isspace() for c in chunk[1:]):
            words.append(chunk[1:])
    return {w: len(e.ids) for w, e in zip(words, bpe.library.encode_batch([" " + w for w in words], add_special_tokens=False))}


def _coder(path: str, table: dict[str, int]) -> TextCoder:
    if path not in _coders:
        bpe = ByteBpe.open(path)
        _coders[path] = TextCoder(lambda words: [len(x) // 4 for x in bpe.words_ids(words)], lambda t: len(bpe.ids(t)), sum, bpe.holds_added, table)
    return _coders[path]


def _piece_coder(path: str):
    from tidemark.llm.pieces import Pieces

    p = Pieces.open(path)
    return lambda text: len(p.bytes_of_all(text)) // 4


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for each row; *tokenizer* is a .json (tokenizers) or .model (sentencepiece) file.

    A null text counts as empty (0 bytes, 0 tokens); null ids and repeated rows each keep their row; other
    columns, whatever their names, are not read; an empty table gives an empty result.
    """
    table = docs.sparkSession.sparkContext.broadcast({} if tokenizer.endswith(".model") else frequent_lengths(tokenizer))

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        coder = _piece_coder(tokenizer) if tokenizer.endswith(".model") else _coder(tokenizer, table.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n = pa.array([coder(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()), n], ["id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    counted = map_arrow(rows, count, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
