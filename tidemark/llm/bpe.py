"""Operator 5, byte-level BPE encoding and decoding by forced-boundary splitting.

No merge ever crosses a pair of neighbouring bytes that occurs inside no token of the
vocabulary, so such a pair is a certain cut: fragments between cuts are encoded on
their own and their ids are joined. The table of such pairs is computed from the vocabulary. It is used twice:

* Over the text: a cut before a run of ASCII white space, where every pair (other byte,
  white space) is certain. The vocabulary's pre-tokenizer starts anew there as well, so a fragment's ids
  depend on the fragment alone: the distinct fragments of a slice of texts are encoded once and their ids gathered for each occurrence.
* Inside each pre-token of a fragment: at every certain pair, before the merges run, for all pieces of a slice at once.

Texts with rarer white space (which the pre-tokenizer joins to ASCII white space) are taken as
one fragment each. Special tokens in the text are found first and stand for themselves. Pre-tokens of fragments
with characters beyond ASCII and the Latin letters of two bytes come from the vocabulary's own pre-tokenizer.

Work is a map over texts without a shuffle; the vocabulary (a few MB, whatever the input) is
broadcast. Nothing is kept from one slice to the next, so memory follows the slice (``SLICE_BYTES``; a longer text
is worked through in windows of that size, only its ids are held whole).

Defined results: null text counts as empty, with no ids; decoding gives back the text; rows
that repeat are encoded alike; extra columns pass through, clashing ones are replaced. A vocabulary file of another kind than byte-level
BPE without normalizer, prefix space, dropout and byte fallback raises an error.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.common import lean

SLICE_BYTES = 1 << 21
LONG = 128  # longer pieces between certain cuts are merged one by one with a heap
_NONE = 1 << 40
_BITS = 20  # of an id in a pair's key
_SPACE = b" \t\n\r"
#: other characters that a pre-tokenizer may take as white space, as UTF-8
_RARE_SPACE = re.compile(
    rb"[\x0b\x0c\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe1\xa0\x8e|\xe2\x80[\x80-\x8b\xa8\xa9\xaf]|\xe2\x81[\x9f\xa0]"
    rb"|\xe3\x80\x80|\xef\xbb\xbf")

_IS_SPACE, _IS_RARE_LEAD = np.zeros(256, bool), np.zeros(256, bool)
_IS_SPACE[list(_SPACE)] = True
_IS_RARE_LEAD[[0x0B, 0x0C, *range(0x1C, 0x20), 0xC2, 0xE1, 0xE2, 0xE3, 0xEF]] = True

# classes of bytes for the pre-tokens
_WHITE, _LETTER, _DIGIT, _OTHER, _BEYOND = 0, 1, 2, 3, 4
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[list(_SPACE)] = _WHITE
_CLASS[[*range(65, 91), *range(97, 123)]] = _LETTER
_CLASS[48:58] = _DIGIT
_CLASS[128:] = _BEYOND


def byte_letters() -> dict[str, int]:
    """Byte of each letter that vocabularies of byte-level BPE write it as: printable ones
    stand for themselves, the others for the code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _classes(raw: np.ndarray) -> np.ndarray:
    """Class of each byte; the letters U+00C0 to U+00FF (without the two signs among them) are two bytes of class letter."""
    out = _CLASS[raw]
    lead = np.flatnonzero(raw[:-1] == 0xC3)
    lead = lead[~np.isin(raw[lead + 1], (0x97, 0xB7))]
    out[lead] = out[lead + 1] = _LETTER
    return out


def _before(x: np.ndarray) -> np.ndarray:
    """Each flag's left neighbour."""
    return np.concatenate([[False], x[:-1]])


def _after(x: np.ndarray, k: int = 1) -> np.ndarray:
    """Each value's right neighbour at distance ``k``, 0 beyond the end."""
    out = np.zeros_like(x)
    out[:-k] = x[k:]
    return out


def _flags(n: int, at: np.ndarray) -> np.ndarray:
    out = np.zeros(n, bool)
    out[at] = True
    return out


def token_starts(raw: np.ndarray, edge: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Flags of the first bytes of pre-tokens; ``edge`` flags the first bytes of fragments, which hold no byte of class beyond.

    A token is a run of letters, of digits or of others with the one space before it, if there is one; a run of white space up to its last
    character, which is a token of its own unless it is a space; or a short form behind an apostrophe."""
    n = len(raw)
    same = np.zeros(n, bool)
    same[1:] = ~edge[1:] & (kind[1:] == kind[:-1])
    white = kind == _WHITE
    begin = ~same
    # behind a single space its token has begun already
    begin &= ~(~edge & _before(white & (raw == 32)) & ~white)
    last = white.copy()
    last[:-1] &= ~edge[1:] & ~white[1:]
    last[-1:] = False
    begin |= last
    # short forms: the apostrophe begins a token, and the letters are in the same fragment
    one, two = _after(raw), _after(raw, 2) if n > 2 else np.zeros(n, raw.dtype)
    inside = np.zeros(n, bool)
    inside[:-1] = ~edge[1:]
    inside_two = inside & _after(inside)
    mark = begin & (raw == 39) & inside
    short = mark & ((one == ord("s")) | (one == ord("t")) | (one == ord("m")) | (one == ord("d")))
    long = mark & inside_two & (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l")))
    for at, length in ((np.flatnonzero(short), 2), (np.flatnonzero(long), 3)):
        begin[at + 1] = False
        end = at + length
        end = end[end < n]
        begin[end[(kind[end] == _LETTER)]] = True
    return begin


def _spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... (``count`` of them) of all runs, one run after the other."""
    end = np.cumsum(count)
    return np.repeat(start - (end - count), count) + np.arange(end[-1] if len(end) else 0)


def _strings(raw: np.ndarray, starts: np.ndarray) -> pa.DictionaryArray:
    """The parts of ``raw`` from each start to the next, as a dictionary of the distinct ones."""
    at = np.append(starts, len(raw)).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(raw))]).dictionary_encode()


def _parts(values: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and starts of a dictionary's entries."""
    _, at, data = values.buffers()
    at = np.frombuffer(at, np.int64)[values.offset: values.offset + len(values) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]: at[-1]] if len(values) and data is not None else np.zeros(0, np.uint8)
    return raw, at[:-1] - at[0]


class Codec:
    """Encoder and decoder of one vocabulary file (its text is ``spec``)."""

    def __init__(self, spec: str):
        from tokenizers.pre_tokenizers import ByteLevel

        j = json.loads(spec)
        self._check(j)
        self.pre = ByteLevel(add_prefix_space=False)  # all that is used of the library's tokenizer, without its own copy of the vocabulary
        letters = byte_letters()
        vocab = j["model"]["vocab"]
        self.special = {t["content"].encode(): t["id"] for t in j["added_tokens"]}
        ids = {t: i for t, i in vocab.items() if t.encode() not in self.special}
        bytes_of = {i: bytes(letters[c] for c in t) for t, i in ids.items()} | {i: t for t, i in self.special.items()}
        letter = {b: c for c, b in letters.items()}
        self.byte_id = np.array([ids[letter[b]] for b in range(256)], np.int64)
        # bytes of every id, one after the other
        size = max(bytes_of) + 1
        self.lengths = np.array([len(bytes_of.get(i, b"")) for i in range(size)], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(bytes_of.get(i, b"") for i in range(size)), np.uint8)
        # merges: rank of each pair of ids, and the id it becomes
        self.rank: dict[tuple[int, int], int] = {}
        merged = []
        for r, m in enumerate(j["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.rank.setdefault((ids[a], ids[b]), r)
            merged.append(ids[a + b])
        self.merged = np.array(merged or [0], np.int64)
        self._index_pairs()
        # pairs of bytes that stand side by side inside some token
        self.inside = np.zeros((256, 256), bool)
        for t in ids:
            b = [letters[c] for c in t]
            self.inside[b[:-1], b[1:]] = True
        # a cut before white space is certain unless a token holds the byte before it and some white space
        self.uncertain = self.inside[:, list(_SPACE)].any(1)
        self.split_special = re.compile(b"(" + b"|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + b")") if self.special else None

    @staticmethod
    def _check(j: dict) -> None:
        """Only vocabularies whose rules this codec follows."""
        pre, model = j.get("pre_tokenizer") or {}, j["model"]
        known = (model.get("type", "BPE") == "BPE" and j.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
                 and pre.get("use_regex", True) and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
                 and not any(t.get(k) for t in j["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
                 and len(model["vocab"]) < 1 << _BITS)
        if not known:
            raise ValueError("not a byte-level BPE vocabulary of the kind that this codec follows")

    def _index_pairs(self) -> None:
        """An open hash table of the pairs' keys, for look-ups of many pairs at once."""
        pairs = np.array(list(self.rank) or [(0, 0)], np.int64)
        ranks = np.array(list(self.rank.values()) or [_NONE], np.int64)
        keys = pairs[:, 0] << _BITS | pairs[:, 1]
        self.slot_bits = max(4, (4 * len(keys)).bit_length())
        self.slot_keys = np.full(1 << self.slot_bits, -1, np.int64)
        self.slot_ranks = np.full(1 << self.slot_bits, _NONE, np.int64)
        at, left, self.tries = self._slots(keys), np.arange(len(keys)), 0
        while len(left):
            self.tries += 1
            free = left[self.slot_keys[at[left]] < 0]
            slots, first = np.unique(at[free], return_index=True)
            self.slot_keys[slots], self.slot_ranks[slots] = keys[free[first]], ranks[free[first]]
            left = left[self.slot_keys[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & ((1 << self.slot_bits) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.slot_bits)).astype(np.int64)

    def ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; ``_NONE`` where no merge joins them."""
        keys = a << _BITS | b
        at = self._slots(keys)
        out = np.where(self.slot_keys[at] == keys, self.slot_ranks[at], _NONE)
        left = np.flatnonzero((self.slot_keys[at] != keys) & (self.slot_keys[at] >= 0))
        for _ in range(self.tries):
            if not len(left):
                break
            at[left] = (at[left] + 1) & ((1 << self.slot_bits) - 1)
            held = self.slot_keys[at[left]]
            hit = held == keys[left]
            out[left[hit]] = self.slot_ranks[at[left[hit]]]
            left = left[~hit & (held >= 0)]
        return out

    def _merge_long(self, parts: list[int]) -> list[int]:
        """Ids of one long piece: a heap of pairs over a linked list, O(n log n)."""
        n = len(parts)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, k, parts[k], parts[k + 1]) for k in range(n - 1) if (r := self.rank.get((parts[k], parts[k + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, k, a, b = heapq.heappop(heap)
            m = after[k]
            if parts[k] != a or m < 0 or parts[m] != b:
                continue
            parts[k], parts[m] = int(self.merged[r]), -1
            after[k] = after[m]
            if after[k] >= 0:
                before[after[k]] = k
            for x, y in ((before[k], k), (k, after[k])):
                if x >= 0 and y >= 0 and (r := self.rank.get((parts[x], parts[y]))) is not None:
                    heapq.heappush(heap, (r, x, parts[x], parts[y]))
        return [p for p in parts if p >= 0]

    def merge(self, raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces of ``raw`` one after the other, and each piece's number of them. In every round each piece
        that still has a pair to join joins the leftmost of its lowest rank."""
        n, pieces = len(raw), len(starts)
        size = np.diff(np.append(starts, n))
        ids = self.byte_id[raw]
        done_piece, done_ids = [], []
        for p in np.flatnonzero(size > LONG):
            got = self._merge_long(ids[starts[p]: starts[p] + size[p]].tolist())
            done_piece.append(np.full(len(got), p))
            done_ids.append(np.array(got, np.int64))
        piece = np.repeat(np.arange(pieces), size)
        if done_piece:
            few = np.repeat(size <= LONG, size)
            ids, piece = ids[few], piece[few]
        rank = np.full(len(ids), _NONE, np.int64)
        pair = np.flatnonzero(piece[1:] == piece[:-1])
        rank[pair] = self.ranks_of(ids[pair], ids[pair + 1])
        while len(ids):
            first = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
            best = np.minimum.reduceat(rank, first)
            count = np.diff(np.append(first, len(ids)))
            ended = np.repeat(best == _NONE, count)
            if ended.any():
                done_piece.append(piece[ended])
                done_ids.append(ids[ended])
                ids, piece, rank = ids[~ended], piece[~ended], rank[~ended]
                best, count = best[best < _NONE], count[best < _NONE]
                if not len(ids):
                    break
            at = np.flatnonzero(rank == np.repeat(best, count))
            at = at[np.append(True, piece[at[1:]] != piece[at[:-1]])]
            ids[at] = self.merged[rank[at]]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, piece, rank = ids[keep], piece[keep], rank[keep]
            at = at - np.arange(len(at))  # one id before each was taken out
            new = np.concatenate([at, at - 1])
            new = new[new >= 0]
            joined = new < len(ids) - 1
            joined[joined] = piece[new[joined]] == piece[new[joined] + 1]
            rank[new[~joined]] = _NONE
            rank[new[joined]] = self.ranks_of(ids[new[joined]], ids[new[joined] + 1])
        if not done_piece:
            return np.zeros(0, np.int64), np.zeros(pieces, np.int64)
        piece, ids = np.concatenate(done_piece), np.concatenate(done_ids)
        return ids[np.argsort(piece, kind="stable")], np.bincount(piece, minlength=pieces)

    def tokens(self, raw: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens that begin at the flags ``begin``, and each one's number of them: distinct ones are cut at the certain pairs."""
        words = _strings(raw, np.flatnonzero(begin))
        part, starts = _parts(words.dictionary)
        cut = _flags(len(part), starts)
        cut[1:] |= ~self.inside[part[:-1], part[1:]]
        cuts = np.flatnonzero(cut)
        ids, count = self.merge(part, cuts)
        each = np.add.reduceat(count, np.searchsorted(cuts, starts)) if len(starts) else count
        start = np.cumsum(each) - each
        number = words.indices.to_numpy()
        return ids[_spread(start[number], each[number])], each[number]

    def _library_starts(self, raw: np.ndarray, at: int, end: int, begin: np.ndarray) -> None:
        """Flags of the pre-tokens of one fragment as the vocabulary's own pre-tokenizer has them; a letter of theirs is a byte."""
        sizes = [len(t) for t, _ in self.pre.pre_tokenize_str(raw[at:end].tobytes().decode())]
        begin[at:end] = False
        begin[at + np.cumsum([0, *sizes[:-1]])] = True

    def plain(self, raw: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First bytes of the fragments of texts that begin at ``edge`` and hold neither special tokens nor rare white space, the ids of all
        fragments, and each one's number of them."""
        white = _IS_SPACE[raw]
        cut = edge.copy()
        cut[1:] |= white[1:] & ~white[:-1] & ~self.uncertain[raw[:-1]]
        at = np.flatnonzero(cut)
        fragments = _strings(raw, at)
        part, starts = _parts(fragments.dictionary)
        first = _flags(len(part), starts)
        kind = _classes(part)
        begin = token_starts(part, first, kind)
        ends = np.append(starts[1:], len(part))
        for k in np.flatnonzero(np.add.reduceat(kind == _BEYOND, starts) > 0) if len(starts) else ():
            self._library_starts(part, starts[k], ends[k], begin)
        ids, count = self.tokens(part, begin)
        each = np.add.reduceat(count, np.searchsorted(np.flatnonzero(begin), starts)) if len(starts) else count
        start = np.cumsum(each) - each
        number = fragments.indices.to_numpy()
        return at, ids[_spread(start[number], each[number])], each[number]

    def encode_slice(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and each one's number of them."""
        texts = len(offsets) - 1
        out, counts = [], np.zeros(texts, np.int64)
        odd = self._odd(raw, offsets)
        at = 0
        for k in [*np.flatnonzero(odd), texts]:
            a = at
            while a < k:  # windows of usual texts
                b = max(a + 1, min(int(np.searchsorted(offsets, offsets[a] + SLICE_BYTES, "right")) - 1, k))
                ids, each = self._usual(raw[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
                out.append(ids)
                counts[a:b] = each
                a = b
            if k < texts:
                ids = self._with_special(raw[offsets[k]: offsets[k + 1]].tobytes())
                out.append(ids)
                counts[k] = len(ids)
            at = k + 1
        return (np.concatenate(out) if out else np.zeros(0, np.int64)), counts

    def _odd(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Texts with rare white space or special tokens."""
        body, out = raw.tobytes(), np.zeros(len(offsets) - 1, bool)
        found = [m.start() for m in _RARE_SPACE.finditer(body)] if _IS_RARE_LEAD[raw].any() else []
        if self.split_special is not None and any(s in body for s in self.special):
            found += [m.start() for m in self.split_special.finditer(body)]
        out[np.searchsorted(offsets, found, "right") - 1] = True
        return out

    def _usual(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of usual texts; a text beyond a window is cut before white space, where its fragments end."""
        if not len(raw):
            return np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
        if len(raw) > 2 * SLICE_BYTES:
            white = _IS_SPACE[raw]
            cuts = np.flatnonzero(white[1:] & ~white[:-1] & ~self.uncertain[raw[:-1]]) + 1
            windows = np.unique(np.append([0, len(raw)], cuts[np.searchsorted(cuts, np.arange(SLICE_BYTES, len(raw), SLICE_BYTES)).clip(max=len(cuts) - 1)] if len(cuts) else []))
            if len(windows) > 2:
                got = [self.plain(raw[a:b], _flags(b - a, np.array([0])))[1] for a, b in zip(windows[:-1].astype(int), windows[1:].astype(int))]
                ids = np.concatenate(got)
                return ids, np.array([len(ids)])
        filled = offsets[:-1] < offsets[1:]
        at, ids, each = self.plain(raw, _flags(len(raw), offsets[:-1][filled]))
        counts = np.zeros(len(filled), np.int64)
        counts[filled] = np.add.reduceat(each, np.searchsorted(at, offsets[:-1][filled]))
        return ids, counts

    def _with_special(self, text: bytes) -> np.ndarray:
        out = []
        for k, part in enumerate(self.split_special.split(text) if self.split_special is not None else [text]):
            raw = np.frombuffer(part, np.uint8)
            if k % 2:
                out.append(np.array([self.special[part]], np.int64))
            elif part and _RARE_SPACE.search(part):
                begin = np.zeros(len(raw), bool)
                self._library_starts(raw, 0, len(raw), begin)
                out.append(self.tokens(raw, begin)[0])
            elif part:
                out.append(self._usual(raw, np.array([0, len(raw)]))[0])
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def encode(self, text: bytes) -> list[int]:
        """Ids of one text in UTF-8."""
        return self.encode_slice(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0].tolist()

    def decode_slice(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of all ids, one after the other."""
        return self.bytes[_spread(self.starts[ids], self.lengths[ids])]

    def decode(self, ids) -> str:
        return self.decode_slice(np.asarray(ids, np.int64)).tobytes().decode("utf-8", "replace")


_CODECS: dict[str, Codec] = {}


def codec_of(spec: str) -> Codec:
    """One codec for each vocabulary and worker."""
    key = hashlib.md5(spec.encode()).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = Codec(spec)
    return _CODECS[key]


ENCODED = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())]
DIGESTS = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
           T.StructField("decoded_sha256", T.StringType())]


def encode(docs: DataFrame, vocabulary: str, *, text: str = "text", digests: bool = False, columns: list[str] | None = None) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit) and ``decoded``, the text
    decoded from the ids; with ``digests``, SHA-256 of both instead (without moving them). Of ``docs`` come ``columns`` (all if
    None): texts that are not among them are not sent back by the tasks.

    ``vocabulary`` is the path of a tokenizer file on the driver.
    """
    spark = docs.sparkSession
    with open(vocabulary, encoding="utf-8") as f:
        body = f.read()
    Codec._check(json.loads(body))
    spec = spark.sparkContext.broadcast(body)
    new = DIGESTS if digests else ENCODED
    taken = {f.name for f in new}
    keep = [c for c in (docs.columns if columns is None else columns) if c.lower() not in taken]
    rows = docs.select(*[f"`{c}`" for c in dict.fromkeys([*keep, text])])
    kept = docs.select(*[f"`{c}`" for c in keep]).schema.fields

    def of_slice(codec, raw, offsets):
        """Results of the texts of a slice, in turn."""
        ids, counts = codec.encode_slice(raw, offsets)
        ends = np.cumsum(counts)
        for a, b in zip(ends - counts, ends):
            mine = ids[a:b]
            back = b"".join(codec.decode_slice(mine[k: k + SLICE_BYTES // 4]).tobytes() for k in range(0, len(mine), SLICE_BYTES // 4))
            as_bytes, back = mine.astype("<u4").tobytes(), back.decode("utf-8", "replace")
            if digests:
                yield int(b - a), hashlib.sha256(as_bytes).hexdigest(), hashlib.sha256(back.encode()).hexdigest()
            else:
                yield int(b - a), as_bytes, back

    def run(batches):
        codec = codec_of(spec.value)
        for batch in batches:
            texts = pc.fill_null(batch.column(text).cast(pa.large_string()), "")
            out = []
            _, at, data = texts.buffers()
            offsets = np.frombuffer(at, np.int64)[texts.offset: texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
            raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
            i = 0
            while i < len(texts):
                j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE_BYTES, "right")) - 1)
                out += of_slice(codec, raw[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i])
                i = j
            n, ids, decoded = zip(*out) if out else ((), (), ())
            arrays = [pa.array(n, pa.int64()), pa.array(ids, pa.string() if digests else pa.binary()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *arrays], names=[*keep, *[f.name for f in new]])

    return rows.mapInArrow(lean(run), T.StructType([*kept, *new]))
