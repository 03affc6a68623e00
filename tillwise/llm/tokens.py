"""Token counts of whole texts, huge ones encoded in overlapping chunks that are spliced where they agree.

A chunk is encoded with the offsets of its tokens. Two chunks that overlap are spliced behind a token which both have, with
the same piece, begin and end. That the spliced tokens are those of the whole text has a proof: merging pairs by rank gives a
sequence of tokens if and only if it gives every two neighbours of it for their own text (the first merge across a border would be
one within the two). Neighbours up to the common token stand in the first encoding, those behind it in the second, and
each is an encoding by the library. What a chunk's cut ends and the space put before each chunk change falls away with the
tokens outside the splices. Where no token is common the overlap grows, also by single characters so that
repeated letters fall into step; where no overlap within a chunk helps, the chunks double until one holds the text.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from tillwise.llm import common
from tillwise.llm.bpe import shipped

#: Characters of a chunk, and by how many two chunks overlap at first.
CHUNK, OVERLAP = 1 << 16, 64
#: Overlaps, each a character longer, that are tried before the overlap doubles.
SHIFTS = 16
#: Tokens from which on a text is over the limit.
LIMIT = 4096


def encoded(model: sentencepiece.SentencePieceProcessor, text: str, at: int) -> np.ndarray:
    """Piece, begin and end in the text of each token of a chunk that begins at ``at``."""
    found = model.encode(text, return_type="offset_mapping")
    spans = np.array(found["offsets"], np.int64).reshape(-1, 2) + at
    return np.column_stack([np.array(found["ids"], np.int64), spans])


def splice(one: np.ndarray, other: np.ndarray) -> tuple[int, int] | None:
    """How many tokens of the first chunk to take and of the second to leave: up to the last token that both have."""
    if not len(one) or not len(other):
        return None
    first = int(np.searchsorted(one[:, 2], other[0, 1], "right"))  # what ends before the second begins can't be common
    last = int(np.searchsorted(other[:, 2], one[-1, 2], "right"))
    places = {tuple(token): i for i, token in enumerate(other[:last].tolist()) if token[1] < token[2]}
    for i in range(len(one) - 1, first - 1, -1):
        if (j := places.get(tuple(one[i].tolist()))) is not None:
            return i + 1, j + 1
    return None


def spliced(model: sentencepiece.SentencePieceProcessor, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> tuple[int, int]:
    """The number of tokens of the whole text, and of the chunks that gave them."""
    if len(text) <= chunk:
        return len(model.encode(text)), 1
    end, count, chunks = chunk, 0, 1
    held = encoded(model, text[:end], 0)
    while end < len(text):
        upto = min(len(text), end + chunk)
        for step in range(SHIFTS * chunk.bit_length()):
            back = (overlap << step // SHIFTS) + step % SHIFTS
            if back > end - held[0, 1]:  # tokens before the held ones are settled
                return spliced(model, text, 2 * chunk, 2 * overlap)
            new = encoded(model, text[end - back : upto], end - back)
            if (cut := splice(held, new)) is not None and cut[1] < len(new):
                break
        else:
            return spliced(model, text, 2 * chunk, 2 * overlap)
        count, held, end, chunks = count + cut[0], new[cut[1] :], upto, chunks + 1
    return count + len(held), chunks


@cache
def model_of(name: str) -> sentencepiece.SentencePieceProcessor:
    """The model of this Python process; tasks that follow each other share it."""
    return sentencepiece.SentencePieceProcessor(model_file=SparkFiles.get(name))


def counts(docs: DataFrame, path: str, limit: int = LIMIT, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens) and n_chunks of every row.

    ``path`` leads to a sentencepiece model of kind BPE that leaves texts as they are (identity). No begin, end or other
    special token is added, and strings like ``<s>`` are plain text. Null and empty texts have no tokens and one chunk. Rows
    without id, repeated rows and rows that share an id are counted like others; further columns take no part. Nothing is
    shuffled, and a task holds the tokens of two chunks, however long the text, unless it nowhere falls into step.
    """
    name = shipped(docs.sparkSession, path)

    def make():
        model = model_of(name)

        def of(texts: list[bytes]) -> list:
            plain = [t.decode() for t in texts]
            short = iter(model.encode([t for t in plain if len(t) <= chunk], num_threads=1))
            found = [(len(next(short)), 1) if len(t) <= chunk else spliced(model, t, chunk) for t in plain]
            n = pa.array([n for n, _ in found], pa.int64())
            return [pa.array(map(len, texts), pa.int64()), n, pa.array([n > limit for n, _ in found], pa.bool_()), pa.array([c for _, c in found], pa.int32())]

        return of

    return common.over_texts(common.documents(docs), make, "n_bytes long, n_tokens long, over_limit boolean, n_chunks int")
