"""Byte-pair encoding by a deterministic automaton over tokens.

The automaton starts as one state with an arc for each byte. Each merge (u, v), in rank order,
adds a merge gadget: the state q that all u-arcs enter gets a copy without q's v-arc, all u-arcs
are led to the copy, and every state with a u-arc gets an arc labelled uv to where v-arcs lead.
In the finished automaton a token sequence is a path exactly when it is what the merges make of
its bytes, so every prefix of a word has one path.

All arcs with one label enter one state, so the automaton has a state for each merge and one more.
A state differs from the state it was copied from by a single missing arc; arcs for later merges
follow from their left part. The gadgets, keyed by their pair, therefore say of every arc whether
it is there.

To read bytes, the automaton is made deterministic over them: a byte state is the set of token
states from which some arc's label is under way, each with how far it has come (a node of the
labels' trie). As every prefix of a word has one path, each byte completes exactly one arc. The
table (byte state, byte) -> (next byte state, token of the arc completed) is filled as it is walked
and bounded; a word is read by one table entry a byte, without search, and its tokens are emitted
from the completed arcs, last to first.

Words are pre-split as the vocabulary's library does it: the pattern is fixed, what is a letter, a
number or white space is asked of the library itself, once for each character met.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from hashlib import sha256
from pathlib import Path
from struct import Struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import HELD, Memo, arrow_slices, let_go, space_led

#: The pre-splitting pattern of the byte-level vocabulary, over character classes: L other
#: letters than those of the contractions, N numbers, S white space but the blank, O all else.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?[Ldelmrstv]+| ?N+| ?[O']+|[ S]+(?![^ S])|[ S]+"
#: Words that a worker keeps: fewer than before a library, as the table reads them again quickly.
MEMO_ENTRIES = 200_000
#: Entries of the table of byte states that a worker keeps.
STEPS_KEPT = 120_000
NEVER = 1 << 62


class CharacterClasses(dict):
    """Code point -> its class in SPLIT, found by what the library's pre-tokenizer does with it."""

    def __init__(self, pre_split: Callable[[str], list]):
        super().__init__({ord(c): c for c in " 'delmrstv"})
        self.pre_split = pre_split

    def __missing__(self, code: int) -> str:
        c = chr(code)
        joins = lambda x: len(self.pre_split(x + c)) == 1
        self[code] = "L" if joins("a") else "N" if joins("1") else "O" if joins(".") else "S"
        return self[code]


@lru_cache(maxsize=2)
def library_classes(path: str) -> CharacterClasses:
    """Of a vocabulary file whose pre-splitting is the byte-level one; another is an error."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    kind = str(tok.pre_tokenizer)
    if not (kind.startswith("ByteLevel(") and "add_prefix_space=False" in kind and "use_regex=True" in kind and tok.normalizer is None):
        raise ValueError(f"{path} isn't a plain byte-level vocabulary")
    return CharacterClasses(tok.pre_tokenizer.pre_tokenize_str)


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies: printable bytes
    stand for themselves, the others for the code points from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Trie:
    """The trie of labels in flat arrays, as a worker holds it beside all else: nodes are numbered by levels, so a
    node's children are neighbours. trie[node].get(byte) is the child, or None."""

    def __init__(self, labels: Iterable[tuple[bytes, int]]):
        known = sorted(labels)
        self.by, self.begin, self.ends = bytearray(1), array("i"), array("i")
        level, depth = [(0, len(known))], 0
        while level:
            below = []
            for low, high in level:
                ended = low < high and len(known[low][0]) == depth
                self.ends.append(known[low][1] if ended else -1)
                self.begin.append(len(self.by))
                low += ended
                while low < high:
                    byte, first = known[low][0][depth], low
                    while low < high and known[low][0][depth] == byte:
                        low += 1
                    self.by.append(byte)
                    below.append((first, low))
            level, depth = below, depth + 1
        self.begin.append(len(self.by))

    def child(self, node: int, byte: int) -> int:
        """The child, or -1."""
        return self.by.find(byte, self.begin[node], self.begin[node + 1])

    def goes_on(self, node: int) -> bool:
        return self.begin[node] < self.begin[node + 1]

    def __len__(self) -> int:
        return len(self.ends)

    def __getitem__(self, node: int) -> dict[int, int]:
        return {self.by[to]: to for to in range(self.begin[node], self.begin[node + 1])}


class PackedSets:
    """Byte states, each a tuple of pairs of whole numbers, kept as bytes."""

    _pair = Struct("<ii")

    def __init__(self):
        self._kept: list[bytes] = []
        self._numbers: dict[bytes, int] = {}

    def number(self, pairs: Iterable[tuple[int, int]]) -> int:
        """The number of a state, a new one if need be."""
        packed = b"".join([self._pair.pack(*x) for x in pairs])
        new = self._numbers.setdefault(packed, len(self._kept))
        if new == len(self._kept):
            self._kept.append(packed)
        return new

    def __len__(self) -> int:
        return len(self._kept)

    def __getitem__(self, state: int) -> tuple[tuple[int, int], ...]:
        return tuple(self._pair.iter_unpack(self._kept[state]))


class TokenAutomaton:
    """Compiled from a byte-level BPE file of the tokenizers library."""

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]], classes: CharacterClasses, special: dict[str, int] | None = None):
        letters = byte_letters()
        self.special = dict(special or {})
        self.labels: list[bytes] = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for word, token in vocab.items():
            if all(c in letters for c in word):
                self.labels[token] = bytes(letters[c] for c in word)
        for word, token in self.special.items():
            self.labels[token] = word.encode()
        self.rank, self.left, self.right = (array("i", [-1]) * len(self.labels) for _ in range(3))
        self.enters = array("i", [0]) * len(self.labels)
        self.gadget: dict[int, int] = {}
        parent, without, made = (array("i", [-1]) for _ in range(3))
        reachable = {t for w, t in vocab.items() if len(w) == 1 and w in letters}
        for rank, (a, b) in enumerate(merges):
            u, v, uv = vocab[a], vocab[b], vocab[a + b]
            if uv in reachable or u not in reachable or v not in reachable or not self.has_arc(u, v):
                continue  # no text comes to this merge
            target = self.enters[v]
            parent.append(self.enters[u])
            without.append(v)
            made.append(rank)
            self.enters[uv] = target
            self.enters[u] = len(parent) - 1
            self.rank[uv], self.left[uv], self.right[uv] = rank, u, v
            self.gadget[u << 32 | v] = rank
            reachable.add(uv)
        self.parent, self.without, self.made = parent, without, made
        #: The trie of labels, and the token that ends at each of its nodes.
        self._next = Trie((self.labels[token], token) for token in reachable)
        self._ends = self._next.ends
        self.sizes = [len(x) for x in self.labels]
        self._classes, self._spans = classes, re.compile(SPLIT).finditer
        self._cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else None
        self._forget()

    def _forget(self) -> None:
        self._sets, self._table = PackedSets(), {}
        self._sets.number([(0, -1)])

    @classmethod
    def from_file(cls, path: str) -> TokenAutomaton:
        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        return cls(model["vocab"], merges, library_classes(path), {x["content"]: x["id"] for x in spec.get("added_tokens", [])})

    def has_arc(self, before: int, token: int) -> bool:
        """Whether the state that arcs labelled before enter has an arc with this token.

        The states copied on the way to it stem from the gadgets (r, v) of the token before, of its
        right part, of that one's right part and so on, each while it was the last token. A gadget
        takes v's arc, and with it the arcs of all later merges whose leftmost part is v.
        """
        rank, left, right, gadget = self.rank, self.left, self.right, self.gadget
        r, until = before, NEVER
        while r >= 0:
            x, later = token, NEVER
            while x >= 0:
                if (made := gadget.get(r << 32 | x)) is not None and made < until and made <= later:
                    return False
                later = rank[x]
                x = left[x]
            until = rank[r]
            r = right[r]
        return True

    def has_arc_by_states(self, state: int, token: int) -> bool:
        """The same read from the chain of states that the compilation has made: slower, for tests."""
        at = token
        while state:
            if self.made[state] <= self.rank[at]:
                at = self.left[at]
            elif self.without[state] == at:
                return False
            else:
                state = self.parent[state]
        return True

    def step(self, state: int, byte: int) -> tuple[int, int]:
        """The table's entry (next byte state, token of the arc that the byte completes)."""
        live, token = [], -1
        for node, before in self._sets[state]:
            to = self._next.child(node, byte)
            if to < 0:
                continue
            ends = self._ends[to]
            if ends >= 0 and (before < 0 or self.has_arc(before, ends)):
                token = ends
            if self._next.goes_on(to):
                live.append((to, before))
        if token < 0:
            raise ValueError("the vocabulary has no token for some byte of this word")
        live.append((0, token))
        new = self._sets.number(live)
        self._table[state << 8 | byte] = new, token
        return new, token

    def word(self, word: bytes) -> list[int]:
        """The tokens of one pre-split word: a table entry a byte, then the arcs from the last to the first."""
        if len(self._table) > STEPS_KEPT:
            self._forget()
        table, state, ended = self._table, 0, []
        for byte in word:
            state, token = table.get(state << 8 | byte) or self.step(state, byte)
            ended.append(token)
        out, i, sizes = [], len(word), self.sizes
        while i:
            token = ended[i - 1]
            out.append(token)
            i -= sizes[token]
        out.reverse()
        return out

    def words(self, text: str) -> list[str]:
        """Pre-split text without special strings."""
        return [text[slice(*m.span())] for m in self._spans(text.translate(self._classes))]

    def _pieces(self, pieces: list[str]) -> Iterator[bytes]:
        """Tokens, packed, of each piece: special strings first, then pre-split words."""
        for piece in pieces:
            ids: list[int] = []
            for part in self._cut(piece) if self._cut else [piece]:
                if part in self.special:
                    ids.append(self.special[part])
                elif part:
                    for word in self.words(part):
                        ids += self.word(word.encode())
            yield np.array(ids, "<u4").tobytes()

    @property
    def memo(self) -> Memo:
        if not hasattr(self, "_memo"):
            self._memo = Memo(self._pieces, space_led, True, self.special, entries=MEMO_ENTRIES)
        return self._memo

    def encode_packed(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return self.memo.packed(texts)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed([text])[0], "<u4").tolist()

    def decode(self, ids: Iterable[int]) -> str:
        """The labels of the arcs, one after the other; bytes that aren't UTF-8 become U+FFFD."""
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def automaton(path: str) -> TokenAutomaton:
    """A worker compiles a vocabulary once, until another operator takes it; what others hold goes first."""
    let_go()
    HELD["automaton"], HELD["classes"] = automaton.cache_clear, library_classes.cache_clear
    return TokenAutomaton.from_file(path)


def bpe_encode(docs: DataFrame, vocabulary: str, text_col: str = "text", id_col: str = "doc_id", ids_col: str = "ids", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, kept columns, ids array<int>) of every row: its whole text, encoded. A null text is as an empty one and
    gets an empty array. No shuffle. Repeated rows come out repeated; other columns don't matter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(vocabulary)
        for part, texts in arrow_slices(batches, "text"):
            flat, sizes = machine.memo.encoded(texts)
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat.view("<i4")))
            yield pa.RecordBatch.from_arrays([*part.columns[1:], ids], names=[id_col, *keep, ids_col])

    chosen = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("id"), *(F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)))
    fields = [f"`{name}` {field.dataType.simpleString()}" for name, field in zip([id_col, *keep], chosen.schema.fields[1:], strict=True)]
    return chosen.mapInArrow(run, ", ".join([*fields, f"`{ids_col}` array<int>"]))


def bpe_decode(rows: DataFrame, vocabulary: str, ids_col: str = "ids", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) of every row of ids. Null ids give a null text; an id outside the vocabulary is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(vocabulary)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                texts = [None if x is None else machine.decode(x) for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(texts, pa.string())], names=[id_col, text_col])

    chosen = rows.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return chosen.mapInArrow(run, f"`{id_col}` {chosen.schema['id'].dataType.simpleString()}, `{text_col}` string")


def bpe_round_trip(docs: DataFrame, vocabulary: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row: encodes its whole text, decodes the
    ids and digests both, in one pass and without writing the ids. Null is as empty: no tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(vocabulary)
        for part, texts in arrow_slices(batches, "text"):
            ids, n = machine.memo.encoded(texts)
            ends, of_ids, of_text = np.cumsum(n).tolist(), [], []
            for a, b in zip([0, *ends], ends, strict=False):
                own = ids[a:b]
                of_ids.append(sha256(own).hexdigest())
                of_text.append(sha256(machine.decode(own.tolist()).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = chosen.schema["id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
