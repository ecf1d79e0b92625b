"""Byte-level BPE by dynamic programming over prefixes.

Every byte prefix of a piece has exactly one token that can end its encoding:
the longest suffix of the prefix that is a token and is compatible with the last
token of the prefix before it.  Storing these tokens gives the encoding by
walking back, allows exact appends, and makes an edit cost what lies near it.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from lakestrata.llm.common import fresh, slices

NONE = -1
SCALAR_FROM = 96  # longer pieces go one by one
PIECES_HELD = 150_000  # encodings a task keeps; it then starts anew
BYTES_AT_ONCE = 1 << 20
PAIR_SHIFT = 20  # ids are below 2**20
MEMO_BITS = 19  # recent verdicts on pairs of tokens


@dataclass(frozen=True)
class Vocabulary:
    """Tables of a rank file; their size depends on the vocabulary only.

    `left`, `right`: the merge a token comes from (a byte: the token itself).
    `parent`, `label`, `token`: the trie of all tokens, by depth; `token` is -1
    at inner nodes.
    """

    tokens: list[bytes]
    left: np.ndarray
    right: np.ndarray
    parent: np.ndarray
    label: np.ndarray
    token: np.ndarray
    depth_ends: list[int]


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a file with lines `base64 rank`, by rank."""
    with open(path, "rb") as lines:
        found = {int(rank): base64.b64decode(text) for text, rank in map(bytes.split, lines)}
    if sorted(found) != list(range(len(found))) or len(found) >= 1 << PAIR_SHIFT:
        raise ValueError("ranks must run from 0 without gaps")
    return [found[r] for r in range(len(found))]


def build_vocabulary(tokens: Sequence[bytes]) -> Vocabulary:
    rank = {t: i for i, t in enumerate(tokens)}
    missing = [b for b in range(256) if bytes([b]) not in rank]
    if missing:
        raise ValueError("every byte must be a token")
    left, right, merged = list(range(len(tokens))), list(range(len(tokens))), {}
    for i, t in enumerate(tokens):
        for cut in range(len(t) - 1, 0, -1):
            a, b = rank.get(t[:cut], i), rank.get(t[cut:], i)
            if a < i and b < i and compatible(a, b, left, right, merged):
                left[i], right[i], merged[a, b] = a, b, i
                break
        else:
            if len(t) > 1:
                raise ValueError(f"token {i} is not the merge of two earlier ones")
    parent, label, token, ends = [0], [0], [NONE], [1]
    level, depth = {b"": 0}, 0
    by_depth: dict[int, dict[bytes, None]] = {}
    for t in tokens:
        for n in range(1, len(t) + 1):
            by_depth.setdefault(n, {})[t[:n]] = None
    for depth in sorted(by_depth):
        below = {}
        for text in by_depth[depth]:
            below[text] = len(parent)
            parent.append(level[text[:-1]])
            label.append(text[-1])
            token.append(rank.get(text, NONE))
        level = below
        ends.append(len(parent))
    arrays = [np.array(x, np.int32) for x in (left, right, parent, label, token)]
    return Vocabulary(list(tokens), *arrays, ends)


def compatible(a: int, b: int, left, right, merged) -> bool:
    """Whether BPE leaves tokens a, b side by side: no merge across the border comes first.

    Merges are undone from the latest back; `merged` gives the token of a pair.
    """
    limit = 1 << 40
    while True:
        if merged.get((a, b), limit) < limit:
            return False
        if a > b:
            limit, whole = a, a
            a = right[a]
            if a == whole:  # a byte: go on with the other side
                limit, whole = b + 1, b
                b = left[b]
                if b == whole:
                    return True
        else:
            limit, whole = b + 1, b
            b = left[b]
            if b == whole:
                limit, whole = a, a
                a = right[a]
                if a == whole:
                    return True


class PairTable:
    """Token of a pair of tokens, for arrays; open addressing."""

    def __init__(self, left: np.ndarray, right: np.ndarray):
        whole = np.flatnonzero(left != np.arange(len(left)))
        keys = (left[whole].astype(np.int64) << PAIR_SHIFT) | right[whole]
        bits = max(8, int(4 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys = np.full(1 << bits, NONE, np.int64)
        self.values = np.zeros(1 << bits, np.int32)
        self.mask = (1 << bits) - 1
        slot, todo = self.slot_of(keys), np.arange(len(keys))
        while len(todo):
            free = self.keys[slot[todo]] == NONE
            self.keys[slot[todo[free]]] = keys[todo[free]]
            placed = self.keys[slot[todo]] == keys[todo]
            self.values[slot[todo[placed]]] = whole[todo[placed]]
            todo = todo[~placed]
            slot[todo] = (slot[todo] + 1) & self.mask

    def slot_of(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, a: np.ndarray, b: np.ndarray, default: np.ndarray) -> np.ndarray:
        keys = (a.astype(np.int64) << PAIR_SHIFT) | b
        slot = self.slot_of(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.values[slot], default)
        todo = np.flatnonzero((held != keys) & (held != NONE))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.mask
            held = self.keys[slot[todo]]
            hit = held == keys[todo]
            out[todo[hit]] = self.values[slot[todo[hit]]]
            todo = todo[~hit & (held != NONE)]
        return out


class PrefixEncoder:
    """Encodes byte pieces; built once per task from a Vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        v = vocabulary
        self.tokens = v.tokens
        self.size = np.array([len(t) for t in v.tokens], np.int32)
        self.left, self.right = v.left, v.right
        self.pairs = PairTable(v.left, v.right)
        self.merges: dict[tuple[int, int], int] = {}
        nodes = len(v.parent)
        inner = np.zeros(nodes, bool)
        inner[v.parent] = True
        # Transitions by byte; a node without children has those of its longest proper suffix.
        self.row = np.where(inner, np.cumsum(inner) - 1, 0).astype(np.int32)
        self.goto = np.zeros((int(inner.sum()), 256), np.int32)
        fail, best = np.zeros(nodes, np.int32), v.token.copy()
        ends = v.depth_ends
        for depth in range(len(ends)):
            here = np.arange(ends[depth - 1] if depth else 0, ends[depth])
            if depth:
                own, leaf = here[inner[here]], here[~inner[here]]
                self.row[leaf] = self.row[fail[leaf]]
                self.goto[self.row[own]] = self.goto[self.row[fail[own]]]
                best[here] = np.where(v.token[here] != NONE, v.token[here], best[fail[here]])
            if depth + 1 < len(ends):
                below = np.arange(ends[depth], ends[depth + 1])
                up, by = self.row[v.parent[below]], v.label[below]
                fail[below] = self.goto[up, by] if depth else 0
                self.goto[up, by] = below
        self.best = best  # the longest token that ends at a node's text
        self.shorter = np.full(len(v.tokens), NONE, np.int32)  # the next shorter one
        whole = v.token != NONE
        self.shorter[v.token[whole]] = best[fail[whole]]
        self.longest = int(self.size.max())
        self.memo = np.zeros(1 << MEMO_BITS, np.int64)  # pair and verdict; 0 is no pair that gets there

    def merged(self) -> dict[tuple[int, int], int]:
        """Token of a pair, for pieces that are encoded one by one; made when first needed."""
        if not self.merges:
            pairs = zip(self.left.tolist(), self.right.tolist())
            self.merges = {pair: i for i, pair in enumerate(pairs) if len(self.tokens[i]) > 1}
        return self.merges

    def checked_pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """`compatible` for arrays, remembering recent verdicts."""
        keys = (((a.astype(np.int64) << PAIR_SHIFT) | b) << 1) + 2
        slot = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - MEMO_BITS)).astype(np.int64)
        held = self.memo[slot]
        ok = held == keys + 1
        todo = np.flatnonzero(~ok & (held != keys))
        if len(todo):
            ok[todo] = self.compatible_pairs(a[todo], b[todo])
            self.memo[slot[todo]] = keys[todo] + ok[todo]
        return ok

    def compatible_pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """`compatible` for arrays."""
        ok = np.zeros(len(a), bool)
        at, limit = np.arange(len(a)), np.full(len(a), 1 << 40, np.int64)
        a, b = a.astype(np.int64), b.astype(np.int64)
        while len(at):
            free = self.pairs.get(a, b, limit) >= limit
            if not free.all():
                at, a, b, limit = at[free], a[free], b[free], limit[free]
            part_a, part_b = self.right[a], self.left[b]
            byte_a, byte_b = part_a == a, part_b == b
            ok[at[byte_a & byte_b]] = True
            undo_a = ((a > b) | byte_b) & ~byte_a
            limit = np.where(undo_a, a, b + 1)
            a, b = np.where(undo_a, part_a, a), np.where(undo_a, b, part_b)
            live = ~(byte_a & byte_b)
            at, a, b, limit = at[live], a[live], b[live], limit[live]
        return ok

    def last_tokens(self, piece: bytes, known: Sequence[int] = ()) -> list[int]:
        """The last token of every prefix of `piece`; `known` are those of its first prefixes."""
        last, state = list(known), 0
        for byte in piece[max(0, len(last) - self.longest) : len(last)]:
            state = self.goto[self.row[state], byte]
        for i in range(len(last), len(piece)):
            state = self.goto[self.row[state], piece[i]]
            last.append(self.next_token(last, i, int(self.best[state])))
        return last

    def next_token(self, last: Sequence[int], i: int, token: int) -> int:
        """The one valid token that ends at byte i; `token` is the longest that ends there."""
        while True:
            before = i - int(self.size[token])
            if before < 0 or compatible(last[before], token, self.left, self.right, self.merged()):
                return token
            token = int(self.shorter[token])

    def walk_back(self, last: Sequence[int]) -> list[int]:
        out, i = [], len(last) - 1
        while i >= 0:
            out.append(int(last[i]))
            i -= len(self.tokens[out[-1]])
        return out[::-1]

    def encode(self, pieces: Sequence[bytes]) -> list[list[int]]:
        """Token ids of each piece; short ones advance together, byte by byte."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        out: list[list[int]] = [[]] * len(pieces)
        for i in np.flatnonzero(size > SCALAR_FROM).tolist():
            out[i] = self.walk_back(self.last_tokens(pieces[i]))
        short = np.argsort(-size, kind="stable")
        short = short[size[short] <= SCALAR_FROM]
        cuts = np.searchsorted(np.cumsum(size[short]), np.arange(BYTES_AT_ONCE, size.sum() + 1, BYTES_AT_ONCE))
        for part in np.split(short, cuts):
            part = part.tolist()
            for i, ids in zip(part, self.encode_together([pieces[i] for i in part])):
                out[i] = ids
        return out

    def encode_together(self, pieces: list[bytes]) -> list[list[int]]:
        """The same for short pieces that stand from long to short."""
        size = np.array([len(p) for p in pieces], np.int64)
        start = np.cumsum(size) - size
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        last = np.zeros(len(flat), np.int32)
        state = np.zeros(len(pieces), np.int32)
        for i in range(int(size[0]) if len(size) else 0):
            live = int(np.searchsorted(-size, -i, side="left"))
            state = self.goto[self.row[state[:live]], flat[start[:live] + i]]
            token, todo = self.best[state], np.arange(live)
            while True:
                before = i - self.size[token[todo]]
                rest = before >= 0
                todo, before = todo[rest], before[rest]
                ok = self.checked_pairs(last[start[todo] + before], token[todo])
                todo = todo[~ok]
                if not len(todo):
                    break
                token[todo] = self.shorter[token[todo]]
            last[start[:live] + i] = token
        at, columns, live = start + size - 1, [], np.arange(len(pieces))
        live = live[size > 0]
        while len(live):
            token = last[at[live]]
            columns.append((live, token))
            at[live] -= self.size[token]
            live = live[at[live] >= start[live]]
        if not columns:
            return [[] for _ in pieces]
        owner = np.concatenate([c[0] for c in reversed(columns)])
        ids = np.concatenate([c[1] for c in reversed(columns)])[np.argsort(owner, kind="stable")].tolist()
        ends = np.cumsum(np.bincount(owner, minlength=len(pieces))).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]


class Matches(dict):
    """Ids of recent matches; a new match gets an empty list, filled once its batch is encoded."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> list[int]:
        self.new.append(piece)
        ids = self[piece] = []
        return ids


class Tokenizer:
    """Splits texts by a pattern, encodes each match, and remembers recent matches."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.encoder, self.pattern = PrefixEncoder(vocabulary), regex.compile(pattern)
        self.held = Matches()

    def fill(self) -> None:
        """Encode the new matches; start anew where too many are held."""
        new, self.held.new = self.held.new, []
        for piece, ids in zip(new, self.encoder.encode([p.encode() for p in new])):
            self.held[piece].extend(ids)

    def trim(self) -> None:
        if len(self.held) > PIECES_HELD:
            self.held = Matches()

    def encode(self, text: str | None) -> list[int]:
        matches = (m.group() for m in self.pattern.finditer(text or ""))
        out: list[int] = []
        while pieces := list(islice(matches, PIECES_HELD)):
            self.trim()
            lists = list(map(self.held.__getitem__, pieces))
            self.fill()
            out.extend(chain.from_iterable(lists))
        return out

    def encode_all(self, texts: Sequence[str | None]) -> list[list[int]]:
        """As `encode`, with the new matches of all texts encoded at once."""
        self.trim()
        get, find = self.held.__getitem__, self.pattern.findall
        lists = [
            list(map(get, find(t))) if len(t) <= BYTES_AT_ONCE else None for t in (x or "" for x in texts)
        ]
        self.fill()
        return [
            self.encode(t) if found is None else list(chain.from_iterable(found)) for t, found in zip(texts, lists)
        ]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.encoder.tokens.__getitem__, ids))


class EditableText:
    """An encoded text that follows appends and edits without encoding all of it again."""

    def __init__(self, tokenizer: Tokenizer, text: str = ""):
        self.tokenizer, self.text = tokenizer, text
        self.ends = [m.end() for m in tokenizer.pattern.finditer(text)]
        pieces = [text[a:b].encode() for a, b in zip([0, *self.ends], self.ends)]
        self.last = [tokenizer.encoder.last_tokens(p) for p in pieces]

    def ids(self) -> list[int]:
        return [t for last in self.last for t in self.tokenizer.encoder.walk_back(last)]

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, stop: int, new: str) -> None:
        """Pieces that end before the edit stay; matching resumes there and stops at an old border after it."""
        text = self.text[:start] + new + self.text[stop:]
        shift = len(text) - len(self.text)
        # A match looks one character ahead, and white space may give one back.
        keep = 0
        while keep < len(self.ends) and self.ends[keep] < start:
            keep += 1
        keep = max(0, keep - 1)
        at = self.ends[keep - 1] if keep else 0
        old = {end + shift: i for i, end in enumerate(self.ends) if end >= stop}
        ends, last, resume = [], [], len(self.ends)
        for m in self.tokenizer.pattern.finditer(text, at):
            piece = m.group().encode()
            known = self.known_prefix(keep + len(ends), piece)
            ends.append(m.end())
            last.append(self.tokenizer.encoder.last_tokens(piece, known))
            if m.end() in old and m.end() >= start + len(new):
                resume = old[m.end()] + 1
                break
        self.ends = self.ends[:keep] + ends + [e + shift for e in self.ends[resume:]]
        self.last = self.last[:keep] + last + self.last[resume:]
        self.text = text

    def known_prefix(self, i: int, piece: bytes) -> list[int]:
        """Last tokens of the prefixes that the piece shares with the old piece i."""
        if i >= len(self.last):
            return []
        begin = self.ends[i - 1] if i else 0
        old = self.text[begin : self.ends[i]].encode()
        n = 0
        while n < min(len(old), len(piece)) and old[n] == piece[n]:
            n += 1
        return self.last[i][:n]


def share_vocabulary(spark: SparkSession, ranks_path: str) -> Broadcast:
    """The tables on all executors: some megabytes, whatever the data."""
    return spark.sparkContext.broadcast(build_vocabulary(read_ranks(ranks_path)))


def encode_texts(
    docs: DataFrame,
    vocabulary: Broadcast,
    pattern: str,
    *,
    text_col: str = "text",
    ids_col: str = "token_ids",
    decoded_col: str | None = None,
) -> DataFrame:
    """All columns of `docs` and the token ids of the whole text, special tokens not recognised.

    `decoded_col` also gives the bytes that the ids decode to, in the same pass.
    Nothing is shuffled.  Defined cases: a null text gives no ids, as an empty one
    does; repeated rows are encoded each; a text of any length is encoded whole; an
    empty table gives no rows.  If `docs` has a column called `ids_col`, the new one
    gets a trailing underscore.
    """
    name, held = fresh(docs.columns, ids_col), fresh([*docs.columns, ids_col], "encoded_text")
    columns = docs.columns
    schema = StructType([*docs.schema.fields, StructField(name, ArrayType(IntegerType()))])
    if decoded_col is not None:
        schema = schema.add(fresh(schema.names, decoded_col), BinaryType())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer(vocabulary.value, pattern)
        for part in slices(batches, held, 1 << 20):
            ids = tokenizer.encode_all(part.column(held).to_pylist())
            arrays = [part.column(c) for c in columns] + [int_lists(ids)]
            if decoded_col is not None:
                arrays.append(pa.array(map(tokenizer.decode, ids), pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.withColumn(held, F.col(text_col).cast("string")).mapInArrow(run, schema)


def int_lists(rows: list[list[int]]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)])
    values = np.fromiter(chain.from_iterable(rows), np.int32, ends[-1])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


def decode_ids(
    docs: DataFrame, vocabulary: Broadcast, *, ids_col: str = "token_ids", bytes_col: str = "decoded"
) -> DataFrame:
    """All columns of `docs` and the bytes that the ids stand for; null ids give no bytes."""
    name, columns = fresh(docs.columns, bytes_col), docs.columns
    schema = StructType([*docs.schema.fields, StructField(name, BinaryType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.value.tokens.__getitem__
        for batch in batches:
            found = [b"".join(map(get, ids or ())) for ids in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], names=[*columns, name])

    return docs.mapInArrow(run, schema)
