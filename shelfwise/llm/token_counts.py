"""Token counts of whole texts, as the vocabulary's own library gives them; ids never leave a task.

A text is cut only where no token can reach across. For a sentencepiece model
these places come from its vocabulary: two neighbouring characters that stand
side by side in no piece. A space after another character is one, if no piece
has a space inside, so texts are cut before their runs of spaces, every
distinct cut of a slice of about SLICE bytes is counted once, and cuts of over
PART characters are cut again at any safe place. The cuts go to the library in
batches of about BATCH bytes, and only their numbers of tokens stay. A model whose normaliser changes texts, or whose pieces have inner
spaces, gets whole texts. For a `tokenizers` file, texts of over PART characters
are cut before a space that follows a letter and is followed by one.

Cuts after the first are given to the library behind a guard, a character of no
piece, whose own tokens are subtracted: the space that the library puts before
each text then does not touch the cut.

Edge cases: null and empty texts count 0 bytes and 0 tokens; strings of special
tokens are counted as the library reads them; repeated rows get equal counts;
an empty table gives an empty result; extra columns are kept if named, unless a
result column has the name.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import slices, space_chunks

#: Documents with more tokens than this are marked.
LIMIT = 4096
#: Bytes of text that a task cuts at once, bytes that the library gets at once, characters of a part.
SLICE, BATCH, PART = 4 << 20, 1 << 18, 1 << 15
#: Cuts of up to SHORT characters are remembered by a task, KNOWN of them at most.
SHORT, KNOWN = 24, 300_000
MARK = "▁"


def balanced(sizes: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Runs (first, end) of texts that hold about `size` bytes each, or one longer text."""
    before = np.concatenate([[0], np.cumsum(sizes)])
    runs, first = [], 0
    while first < len(sizes):
        end = max(first + 1, int(np.searchsorted(before, before[first] + size, "right")) - 1)
        runs.append((first, end))
        first = end
    return runs


class PieceCounter:
    """Counts with a sentencepiece model."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.library.get_piece_size()
        pieces = [self.library.id_to_piece(k) for k in range(size)]
        self.joined = {p[k : k + 2] for p in pieces for k in range(len(p) - 1)}
        used = {c for p, k in zip(pieces, range(size)) if not self.library.is_byte(k) for c in p}
        self.guard = next(c for c in "\n\t\x01\x02\x03" if c not in used)
        self.guard_tokens = len(self.library.encode(self.guard))
        probe = "a  ﬁÅ é 　 x "
        plain = self.library.normalize(probe) == (MARK + probe).replace(" ", MARK)
        self.cuts = plain and not any(pair[1] == MARK != pair[0] for pair in self.joined)
        self.known: dict[str, int] = {}

    def safe(self, text: str, at: int) -> bool:
        return text[at - 1 : at + 1].replace(" ", MARK) not in self.joined

    def parts(self, text: str, size: int) -> list[str]:
        """A cut in parts of about `size` characters, longer where no place is safe; the first is as it is, the others stand behind the guard."""
        out, start = [], 0
        while len(text) - start > size:
            at = next((k for k in range(start + size, start, -1) if self.safe(text, k)), 0) or next((k for k in range(start + size + 1, len(text)) if self.safe(text, k)), 0)
            if not at:
                break
            out.append(text[start:at])
            start = at
        out.append(text[start:])
        return [out[0], *(self.guard + p for p in out[1:])]

    def lengths(self, texts: list[str], batch: int, part: int) -> np.ndarray:
        """Tokens of each text, in batches; long texts in parts."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        long = np.flatnonzero(sizes > part).tolist() if self.cuts else []
        parts, owner = list(texts), list(range(len(texts)))
        for k in long:
            first, *others = self.parts(texts[k], part)
            parts[k] = first
            parts += others
            owner += [k] * len(others)
        sizes = np.fromiter((len(p.encode(errors="replace")) for p in parts), np.int64, len(parts))
        counts = np.zeros(len(parts), np.int64)
        for first, end in balanced(sizes, batch):
            counts[first:end] = list(map(len, self.library.encode(parts[first:end], num_threads=1)))
        counts[len(texts) :] -= self.guard_tokens
        return np.bincount(owner, counts, minlength=len(texts)).astype(np.int64)

    def chunk_counts(self, chunks: list[str], batch: int, part: int) -> np.ndarray:
        """Tokens of cuts that begin with the space which the library puts before each text; short ones are remembered, up to KNOWN."""
        counts = np.fromiter(map(self.known.get, chunks, repeat(-1)), np.int64, len(chunks))
        new = np.flatnonzero(counts < 0).tolist()
        found = self.lengths([chunks[k][1:] for k in new], batch, part)
        for k, n in zip(new, found.tolist()):
            chunk = chunks[k]
            if chunk == " ":  # no text to the library, yet a token behind other text
                n = len(self.library.encode(self.guard + " ")) - self.guard_tokens
            counts[k] = n
            if len(chunk) <= SHORT and len(self.known) < KNOWN:
                self.known[chunk] = n
        return counts

    def column(self, column: pa.Array, batch: int = BATCH, part: int = PART) -> np.ndarray:
        column = pc.fill_null(column, "")
        if not self.cuts:
            return self.lengths(column.to_pylist(), batch, part)
        offsets, codes, chunks = space_chunks(pc.replace_substring(column, MARK, " "), lambda text: re.findall(r" *[^ ]+| +", " " + text) if text else [], True)
        total = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(self.chunk_counts(chunks, batch, part)[codes], out=total[1:])
        return total[offsets[1:]] - total[offsets[:-1]]


class FileCounter:
    """Counts with a file of the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()

    def parts(self, text: str, size: int) -> list[str]:
        out, start = [], 0
        while len(text) - start > size:
            found = re.compile(r"(?<=[a-zA-Z]) (?=[a-zA-Z])").search(text, start + size)
            if not found:
                break
            out.append(text[start : found.start()])
            start = found.start()
        return [*out, text[start:]]

    def column(self, column: pa.Array, batch: int = BATCH, part: int = PART) -> np.ndarray:
        parts, owner = [], []
        for k, text in enumerate(column.to_pylist()):
            own = self.parts(text or "", part)
            parts += own
            owner += [k] * len(own)
        counts = np.zeros(len(parts), np.int64)
        for first, end in balanced(np.array([len(p.encode(errors="replace")) for p in parts], np.int64), batch):
            counts[first:end] = list(map(len, self.library.encode_batch_fast(parts[first:end], add_special_tokens=False)))
        return np.bincount(owner, counts, minlength=len(column)).astype(np.int64)


def counter(path: str) -> PieceCounter | FileCounter:
    return PieceCounter(path) if path.endswith(".model") else FileCounter(path)


def count_tokens(docs: DataFrame, path: str, keep: list[str] | None = None, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """Kept columns, n_bytes, n_tokens, over_limit. path: a .model or .json file that every machine has."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("n_bytes", "n_tokens", "over_limit")]

    def run(batches):
        count = counter(path)
        for batch in batches:
            for first, raw, offsets in slices(batch.column(text), SLICE):
                part = batch.slice(first, len(offsets) - 1)
                n = count.column(part.column(text))
                yield pa.RecordBatch.from_pydict({c: part.column(c) for c in keep} | {"n_bytes": pa.array(np.diff(offsets)), "n_tokens": pa.array(n), "over_limit": pa.array(n > limit)})

    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "n_bytes long, n_tokens long, over_limit boolean"])
    return docs.select(*(F.col(f"`{c}`") for c in dict.fromkeys([*keep, text]))).mapInArrow(run, schema)
