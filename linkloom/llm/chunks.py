"""Word-level memo in front of a tokenizer.

A text is cut into chunks, and these into pieces, that the tokenizer would encode independently of
each other. Arrow and numpy cut a whole slice of texts, find its distinct pieces and put the ids
together again; Python sees each distinct piece once, and a worker's memo of fixed size keeps what
was encoded. Memory doesn't grow with the corpus; what is not in the memo is encoded again.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Rows and characters of a slice of an Arrow batch whose texts are held as Python objects at once.
SLICE_ROWS, SLICE_CHARS = 512, 1_000_000
#: The same for slices that stay in Arrow: the more texts, the fewer distinct pieces a text.
ARROW_ROWS, ARROW_CHARS = 8192, 3_000_000
#: Runs of ids whose places are made at once.
RUNS = 65_536
#: Entries of a worker's memo, and the longest piece that is kept in it.
MEMO_ENTRIES, MEMO_CHARS = 300_000, 24

_UNSAFE = re.compile(r" (?:\s|$)")
_BOUNDARY = re.compile(r" (?=\S)")
_ASCII_SPACE = re.compile("[ \t\n\r\x0b\x0c]+")
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")

#: Letters and punctuation between which every splitting pattern used here cuts: letters of the Latin
#: blocks that stay one letter in lower case, and ASCII punctuation but for the apostrophe.
LETTERS = "".join(chr(c) for c in [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x250)] if c not in (0xD7, 0xF7, 0x130))
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_L, _P = r"A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{24f}", r"!-&(-/:-@\[-`{-~"
_CUT = "\x01"
_WORD_CUTS = ((rf"([{_L}])([{_P}])", rf"\1{_CUT}\2"), (rf"([{_P}])([{_L}])", rf"\1{_CUT}\2"))
_CUTTABLE = rf"[{_P}\n]"
_LINE_CUTS = ((rf"([{_L}{_P}])\n([{_L}{_P}])", f"\\1{_CUT}\n{_CUT}\\2"),)


def space_led(text: str) -> list[str]:
    """Chunks for byte-level splitting, where a space belongs to the word that follows it.

    A space before a non-space always begins a new pre-token there, so cutting before it changes
    nothing; other white space stays inside its chunk. The chunks joined are the text.
    """
    if not text:
        return []
    parts = _BOUNDARY.split(text) if _UNSAFE.search(text) else text.split(" ")
    head, rest = parts[0], [" " + x for x in parts[1:]]
    return [head, *rest] if head else rest


def space_free(text: str) -> list[str]:
    """Chunks for splitting that drops white space: the runs between ASCII spaces."""
    return [x for x in _ASCII_SPACE.split(text) if x] if _ODD_SPACE.search(text) else text.split()


#: Texts that Arrow's splitting would cut differently from ours.
_ARROW_UNSAFE = {
    space_led: r" ([\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|$)",
    space_free: r"^$",
}


def _places(starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places of runs that begin at starts and are n long, one run after the other."""
    done = np.cumsum(n) - n
    out = np.repeat((starts - done).astype(np.int32), n)  # a slice has far fewer than 2^31 ids
    out += np.arange(len(out), dtype=np.int32)
    return out


def _gathered(pool: np.ndarray, starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The runs of pool that begin at starts and are n long, one after the other; some at a time, so that their
    places take little memory."""
    ends = np.concatenate([[0], np.cumsum(n)])
    out = np.empty(int(ends[-1]), pool.dtype)
    for k in range(0, len(n), RUNS):
        part = slice(k, k + RUNS)
        np.take(pool, _places(starts[part], n[part]), out=out[ends[k] : ends[min(k + RUNS, len(n))]], mode="clip")
    return out


def _run_sizes(n: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(n)])[ends])


class Memo:
    """Piece -> its ids as little-endian unsigned 32-bit integers, encoding what is missing in bulk.

    cut says how texts become chunks; fine, whether chunks may further be cut between letters and
    punctuation; no chunk that holds a special string is. Only pieces of up to `chars` characters are
    kept: longer ones seldom come again. A full memo stays as it is until it has missed twice its size,
    that is, until the texts have changed.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable[bytes]], cut: Callable[[str], list[str]], fine: bool = False, special: Iterable[str] = (), entries: int = MEMO_ENTRIES, chars: int = MEMO_CHARS):
        self.encode, self.cut, self.entries, self.chars, self.kept, self.missed = encode, cut, entries, chars, {}, 0
        self.cuts = (_WORD_CUTS + (_LINE_CUTS if cut is space_led else ())) if fine else ()
        self.special = "|".join(map(re.escape, special))

    def values(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces."""
        found = [*map(self.kept.get, pieces)]
        at = [i for i, v in enumerate(found) if v is None]
        if at:
            new = [pieces[i] for i in at]
            values = [*self.encode(new)]
            for i, v in zip(at, values, strict=True):
                found[i] = v
            self._keep(new, values)
        return found

    def _keep(self, new: list[str], values: list[bytes]) -> None:
        room = self.entries - len(self.kept)
        if len(new) > room:
            self.missed += len(new)
            if self.missed > 2 * self.entries:
                self.kept, self.missed, room = {}, 0, self.entries
        chars = self.chars
        self.kept.update((k, v) for k, v in zip(new[: max(0, room)], values, strict=False) if len(k) <= chars)

    def encoded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all texts one after the other, the number of each text's)."""
        unsafe = pc.match_substring_regex(texts, _ARROW_UNSAFE[self.cut]).to_numpy(zero_copy_only=False)
        easy = texts.filter(pa.array(~unsafe)) if unsafe.any() else texts
        ids, sizes = self._easy(easy)
        if not unsafe.any():
            return ids, sizes
        lists = [self.cut(x) for x in texts.filter(pa.array(unsafe)).to_pylist()]
        coded = pa.array([x for part in lists for x in part], pa.string()).dictionary_encode()
        hard_ids, hard_sizes = self._of_chunks(coded.indices.to_numpy().astype(np.int64), coded.dictionary, np.cumsum([0, *map(len, lists)]))
        n = np.empty(len(texts), np.int64)
        n[~unsafe], n[unsafe] = sizes, hard_sizes
        of = np.repeat(unsafe, n)
        out = np.empty(len(of), np.uint32)
        out[~of], out[of] = ids, hard_ids
        return out, n

    def _easy(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        lists = pc.split_pattern(texts, " ") if self.cut is space_led else pc.ascii_split_whitespace(texts)
        ends = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        codes, distinct = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        if self.cut is space_led:  # a text's first chunk has no space before it
            first = ends[:-1]
            heads = distinct.take(pa.array(codes[first]))
            codes[first] = len(distinct) + np.arange(len(heads))
            distinct = pa.concat_arrays([pc.binary_join_element_wise("", distinct, " "), heads])
        return self._of_chunks(codes, distinct, ends)

    def _of_chunks(self, codes: np.ndarray, distinct: pa.Array, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same of texts whose chunks are distinct[codes], each text's up to its end."""
        pieces, piece_ends = self._pieces(distinct)
        coded = pieces.dictionary_encode()
        values = self.values(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, values), np.int64, len(values)) >> 2
        pool = np.frombuffer(b"".join(values), "<u4")
        of = coded.indices.to_numpy()
        n, starts = sizes[of], (np.cumsum(sizes) - sizes)[of]
        pool = _gathered(pool, starts, n)
        sizes = _run_sizes(n, piece_ends)
        n, starts = sizes[codes], (np.cumsum(sizes) - sizes)[codes]
        return _gathered(pool, starts, n), _run_sizes(n, ends)

    def _pieces(self, chunks: pa.Array) -> tuple[pa.Array, np.ndarray]:
        if not self.cuts or pc.any(pc.match_substring(chunks, _CUT)).as_py():
            return chunks, np.arange(len(chunks) + 1)
        held = pc.match_substring_regex(chunks, _CUTTABLE)  # all others have nowhere to be cut
        some = whole = chunks.filter(held)
        for pattern, put in self.cuts:
            some = pc.replace_substring_regex(some, pattern, put)
        if self.special:
            some = pc.if_else(pc.match_substring_regex(whole, self.special), whole, some)
        marked = pc.replace_with_mask(chunks, held, some)
        lists = pc.split_pattern(marked, _CUT)
        return lists.flatten(), lists.offsets.to_numpy().astype(np.int64)

    def packed(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as bytes."""
        ids, sizes = self.encoded(pa.array(texts, pa.string()))
        ends = np.cumsum(sizes).tolist()
        return [ids[a:b].tobytes() for a, b in zip([0, *ends], ends, strict=False)]


def _cuts(batch: pa.RecordBatch, column: str, rows: int, chars: int) -> Iterator[pa.RecordBatch]:
    lengths = pc.binary_length(batch.column(column).fill_null("")).to_numpy(zero_copy_only=False)
    begin = size = 0
    for i, n in enumerate(lengths.tolist()):
        if i > begin and (size + n > chars or i - begin >= rows):
            yield batch.slice(begin, i - begin)
            begin, size = i, 0
        size += n
    if begin < batch.num_rows:
        yield batch.slice(begin)


#: What empties the caches that operators have made in this worker.
HELD: dict[str, Callable[[], None]] = {}


def trimmed() -> None:
    """What Arrow and the C library no longer need goes back to the system, as a worker outlives its task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def let_go(but: str = "") -> None:
    """Empties the caches that operators hold in this worker, but one. Spark gives a worker to one operator after
    the other, and would count a cache against all of them for as long as it lives."""
    others = [x for x in HELD if x != but]
    for x in others:
        HELD.pop(x)()
    if others:
        gc.collect()
        trimmed()


def text_slices(batches: Iterable[pa.RecordBatch], column: str, own: str = "") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The batches in slices of bounded rows and characters, with the column's texts, null as empty: for operators
    that don't encode, so what others hold in this worker goes, but for the operator's own cache."""
    let_go(own)
    for batch in batches:
        for part in _cuts(batch, column, SLICE_ROWS, SLICE_CHARS):
            yield part, part.column(column).fill_null("").to_pylist()
        trimmed()


def arrow_slices(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """The same in larger slices for encoders, the texts staying in Arrow."""
    for batch in batches:
        for part in _cuts(batch, column, ARROW_ROWS, ARROW_CHARS):
            yield part, part.column(column).fill_null("")
        trimmed()
