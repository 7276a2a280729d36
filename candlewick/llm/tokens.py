"""Token counts: batches of equal bytes, lengths only.

Each text is given to the tokenizer in pieces of bounded length; the pieces of many texts form
batches of bounded bytes, so memory does not depend on how long a text is or how texts are dealt
over rows. A long text is cut only where no token can span the cut.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text given to the tokenizer in one call: small enough that its results stay in the processor's cache.
BATCH_BYTES = 1 << 17
#: Characters of a piece of a long text; a stretch without a safe boundary stays whole.
PIECE_CHARS = 1 << 16
#: Texts with any other character are left to the tokenizer of the JSON file: for ASCII and Latin letters
#: every Unicode version agrees on what a letter, a digit or a blank is, so both libraries cut words alike.
PLAIN = "\x00-\x1b\x20-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"


def safe_cut(text: str, start: int, most: int) -> int:
    """End of a piece that starts at ``start``: just before a blank between two ASCII letters.

    The byte-level pre-tokenizer always begins a new word at a single blank that stands between two
    letters, and a blank is part of no special token's string, so pieces are tokenized as in the whole text.
    """
    end = start + most
    while end < len(text):
        at = text.find(" ", end)
        if at < 0 or at + 1 >= len(text):
            return len(text)
        before, after = text[at - 1], text[at + 1]
        if before.isascii() and before.isalpha() and after.isascii() and after.isalpha():
            return at
        end = at + 1
    return len(text)


def pieces(text: str, most: int = PIECE_CHARS) -> Iterator[str]:
    """Cut a text at safe boundaries; the pieces joined are the text."""
    start = 0
    while start < len(text):
        end = safe_cut(text, start, most) if len(text) - start > most else len(text)
        yield text[start:end]
        start = end


def rank_encoder(path: str, pattern: str):
    """Byte-pair encoder from a rank file (one base64 token and its rank a line), without special tokens."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str | None = None,
    ranks_path: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    limit: int = 512,
) -> DataFrame:
    """Bytes and tokens of every text: the id, ``n_bytes``, ``n_tokens``, ``over_limit`` (``n_tokens > limit``).

    ``tokenizer_path``: a ``tokenizers`` JSON file on every executor (default: the public byte-level
    BPE). ``ranks_path``: if given, the same vocabulary as a rank file, whose encoder is four times as fast and takes
    the texts of plain letters without special strings, piece by piece. No begin, end or other added tokens; a special token's string inside a text becomes that
    token, as the library does by default. A null or empty text has 0 bytes and 0 tokens. Every row
    gives one row, repeated ids included; a null id stays null; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task has one core; threads of the library's own would only compete with the other tasks.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        path = tokenizer_path
        pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("byte_bpe_50k.json")
            pattern = public_tokenizers.PATTERN
        fast = rank_encoder(ranks_path, pattern) if ranks_path else None
        tokenizer = Tokenizer.from_file(path)
        special = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
        other = re.compile("|".join(["[^" + PLAIN + "]", *map(re.escape, special)]))
        tokenizer.no_padding()
        tokenizer.no_truncation()
        for batch in batches:
            lengths = [0] * batch.num_rows
            sizes = [0] * batch.num_rows
            owners: list[int] = []
            waiting: list[str] = []
            held = 0

            def flush():
                for owner, encoded in zip(owners, tokenizer.encode_batch_fast(waiting, add_special_tokens=False), strict=True):
                    lengths[owner] += len(encoded)
                owners.clear()
                waiting.clear()

            column = batch.column(1)
            for row in range(batch.num_rows):
                text = column[row].as_py()
                if not text:
                    continue
                sizes[row] = len(text.encode())
                plain = fast is not None and other.search(text) is None
                for piece in pieces(text):
                    if plain:
                        lengths[row] += len(fast.encode_ordinary(piece))
                        continue
                    owners.append(row)
                    waiting.append(piece)
                    held += len(piece.encode())
                    if held >= BATCH_BYTES:
                        flush()
                        held = 0
            flush()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(lengths, pa.int64())], names=["id", "n_bytes", "n_tokens"]
            )

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    counted = rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
