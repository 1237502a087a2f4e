"""Byte-pair encoding as a bounded-lookahead transducer, and its decoder.

A merge list fixes how far a later symbol can change an earlier token: a merge that
happens with one continuation of the text and not with another moves the border of
agreement left by its left part, and only a later merge whose right part begins with that
left part can move it on. `lookahead` is the longest such chain. A token that ends at least
that many symbols before the end of what has been read is final, so a word of any length
is encoded in windows: merge, emit the final tokens, go on behind them. Memory is that of
one window.

Windows of many words are merged side by side (one numpy lane each), and a bounded memo
keeps the tokens of words already seen by the worker.

Words are what the vocabulary file's pipeline makes of a text: NFC, lower case, special
tokens cut out first, then pieces by its pattern. The file's path is a parameter.
"""

from __future__ import annotations

import codecs
import gc
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Regex, Tokenizer, pre_tokenizers

from .common import batch, chunks, word_hashes, words

NONE = np.int32(2**31 - 1)

#: Symbols of a window; longer words are read window by window.
WINDOW = 2048

#: Words that a worker's memo holds before it starts anew, and bytes of the longest word that
#: goes there. A word has no more tokens than bytes, so a quarter of that many words has at
#: most `memo_tokens()` tokens, which is what the memo holds, whatever the texts are.
MEMO_WORDS = 1_000_000
LONG_WORD = 32

#: Lane widths: words are merged beside words of about their length.
_WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 14, 16, 20, 24, 32, 48, 64, 128, 256, 512, 1024, WINDOW)

#: Blanks of the vocabulary's pattern beyond ASCII.
_WIDE_BLANKS = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_PLAIN_ENDS = frozenset(".,;:!?*%&$#)")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes of
    Latin-1 stand for themselves, the others are numbered from 256."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b) if b in own else chr(spare))
        spare += b not in own
    return out


class PairTable:
    """Ranks of symbol pairs; every pair lies in one of two slots, so that two probes tell."""

    def __init__(self, left: np.ndarray, right: np.ndarray):
        self.bits = max(8, int(len(left) * 2.6).bit_length())
        keys = (left.astype(np.uint64) << np.uint64(16)) | right.astype(np.uint64)
        self.keys = np.full(1 << self.bits, 2**32 - 1, np.uint32)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        one, two = (self._slot(keys, k).tolist() for k in (0, 1))
        held: dict[int, int] = {}
        for i in range(len(one)):
            at, turn = one[i], i
            for _ in range(500):
                held[at], turn = turn, held.get(at, -1)
                if turn < 0:
                    break
                at = two[turn] if at == one[turn] else one[turn]
            else:
                raise ValueError("the pair table is too full")
        at = np.fromiter(held.keys(), np.int64, len(held))
        of = np.fromiter(held.values(), np.int64, len(held))
        self.keys[at] = keys[of].astype(np.uint32)
        self.ranks[at] = of.astype(np.int32)

    def _slot(self, keys: np.ndarray, k: int) -> np.ndarray:
        by = np.uint64((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)[k])
        return ((keys * by) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.uint64) << np.uint64(16)) | right.astype(np.uint64)
        short = keys.astype(np.uint32)
        one, two = self._slot(keys, 0), self._slot(keys, 1)
        out = np.where(self.keys[one] == short, self.ranks[one], NONE)
        other = self.keys[two] == short
        out[other] = self.ranks[two[other]]
        return out


def lookahead(merges: list[tuple[str, str]], suffix: str = "") -> int:
    """Symbols that must follow a token before it is final, whatever comes after them.

    Raises ValueError for a list in which a pair stands before the merge that makes one
    of its parts, or which makes a token twice: no bound is known for those.
    """
    made: dict[str, int] = {}
    parts: dict[str, str] = {}
    reach: dict[str, int] = {}
    longest = 0
    size = lambda t: len(t.removesuffix(suffix)) if suffix else len(t)
    for rank, (a, b) in enumerate(merges):
        for part in (a, b):
            if size(part) > 1 and part not in made:
                raise ValueError(f"{part!r} is used before it is made")
        if a + b in made:
            raise ValueError(f"{a + b!r} is made twice")
        made[a + b] = rank
        before, spine = 0, b
        while spine is not None:
            before = max(before, reach.get(spine, 0))
            spine = parts.get(spine)
        reach[a] = max(reach.get(a, 0), size(a) + before)
        longest = max(longest, size(a) + before)
        parts[a + b] = a
    return longest


def memo_tokens() -> int:
    return max(1, MEMO_WORDS // 4) * LONG_WORD


class Memo:
    """Tokens of known words by word hash: open addressing to a word's number, tokens end to
    end in the order of numbers; `bounds` lie between them."""

    def __init__(self):
        self.bits = (2 * MEMO_WORDS - 1).bit_length()
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.place = np.zeros(1 << self.bits, np.int32)
        self.bounds = np.zeros(MEMO_WORDS + 1, np.int64)
        self.ids = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.held = 0

    def full(self, words: int, tokens: int) -> bool:
        return self.held + words > MEMO_WORDS or self.used + tokens > memo_tokens()

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """For each hash its word's number, or -1."""
        keys = np.maximum(hashes, np.uint64(1))
        slot = self._slot(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.place[slot], -1)
        open_ = np.flatnonzero((held != keys) & (held != 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)
            held = self.keys[slot[open_]]
            hit = held == keys[open_]
            out[open_[hit]] = self.place[slot[open_[hit]]]
            open_ = open_[~hit & (held != 0)]
        return out

    def add(self, hashes: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Distinct hashes that are not held yet."""
        keys = np.maximum(hashes, np.uint64(1))
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), len(ids)), np.int32)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.bounds[self.held + 1 : self.held + 1 + len(keys)] = self.used + np.cumsum(counts)
        numbers = np.arange(self.held, self.held + len(keys))
        self.used += len(ids)
        self.held += len(keys)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[slot[left]] == 0
            _, first = np.unique(slot[left[free]], return_index=True)
            put = left[free][first]
            self.keys[slot[put]] = keys[put]
            self.place[slot[put]] = numbers[put]
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + 1) & (len(self.keys) - 1)

    def tokens(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of the found words end to end, and how many each word has."""
        starts = self.bounds[place]
        counts = self.bounds[place + 1] - starts
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        shift = np.repeat(starts - (ends - counts), counts)
        return self.ids[shift + np.arange(total)], counts


class Encoder:
    """Encodes texts with one vocabulary file of the `tokenizers` library."""

    def __init__(self, source: bytes):
        spec = json.loads(source)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.lookahead = lookahead(merges, self.suffix)
        if self.lookahead + 64 > WINDOW:
            raise ValueError("the window is too short for this merge list")
        letters = byte_letters()
        self.inner = np.array([self.vocab[c] for c in letters], np.int32)
        self.final = np.array([self.vocab[c + self.suffix] for c in letters], np.int32)
        ids = lambda k: np.array([self.vocab[m[k]] for m in merges], np.int64)
        self.pairs = PairTable(ids(0), ids(1))
        self.merged = np.array([self.vocab[a + b] for a, b in merges], np.int32)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_at = re.compile("|".join(f"({re.escape(t)})" for t in self.special)) if self.special else None
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern)
        self.rules = Tokenizer.from_str(source.decode()).normalizer
        self.split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        self.tokens: list[str] = [""] * (max([*self.vocab.values(), *self.special.values()]) + 1)
        for token, i in [*self.vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        self.memo = Memo()

    # -- words

    def normal(self, text: str) -> bytes:
        """NFC and lower case, each capital sigma alone, as letters are lowered one by one;
        blanks outside of ASCII become one that `common.words` knows."""
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = _WIDE_BLANKS.sub(" ", text.replace("Σ", "σ"))
        return text.lower().encode("utf-8", "replace")

    def pieces(self, word: str) -> list[str]:
        if word.isalpha():
            return [word]
        if word[-1] in _PLAIN_ENDS and word[:-1].isalpha():
            return [word[:-1], word[-1]]
        if not word.isascii() and any(unicodedata.category(c) == "Cn" for c in word):
            return self.newer_pieces(word)
        return self.pattern.findall(word)

    def newer_pieces(self, word: str) -> list[str]:
        """Pieces of a word with characters that Python's tables don't know yet: the
        library's tables say what their lower case and their class are."""
        word = self.rules.normalize_str(word)
        return [p for p, _ in self.split.pre_tokenize_str(word)]

    def encode_words(self, unknown: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of words, one after another, and how many each has."""
        parts = [self.pieces(w) for w in unknown]
        made = self.encode_pieces(list({p for ps in parts for p in ps}))
        packed = [made[ps[0]] if len(ps) == 1 else b"".join([made[p] for p in ps]) for ps in parts]
        return np.frombuffer(b"".join(packed), "<u4").astype(np.int32), np.array([len(p) // 4 for p in packed], np.int64)

    def encode_texts(self, texts: list[str | None]) -> list[np.ndarray]:
        """Token ids of each text; null counts as empty."""
        marked = {}
        if self.special_at is not None:
            marked = {i: t for i, t in enumerate(texts) if t and "<|" in t and self.special_at.search(t)}
        raw = [self.normal(t) if t and i not in marked else b"" for i, t in enumerate(texts)]
        bounds = np.zeros(len(raw) + 1, np.int64)
        np.cumsum([len(r) for r in raw], out=bounds[1:])
        joined = b"".join(raw)
        data = np.frombuffer(joined, np.uint8)
        starts, ends, at = words(data, bounds)
        hashes = word_hashes(data, starts, ends)
        # In runs of words that an empty memo can hold, so that any number of new words will do.
        run = max(1, MEMO_WORDS // 4)
        ids, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for lo in range(0, len(hashes), run):
            part = slice(lo, lo + run)
            found, many = self.run_tokens(joined, starts[part], ends[part], hashes[part])
            ids.append(found)
            counts.append(many)
        ids = np.concatenate(ids)
        ends = np.cumsum(np.concatenate(counts))
        cut = np.concatenate([[0], ends])[at]
        out = [ids[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
        for i, text in marked.items():
            parts = [p for p in self.special_at.split(text) if p]
            inner = iter(self.encode_texts([p for p in parts if p not in self.special]))
            out[i] = np.concatenate(
                [np.array([self.special[p]], np.int32) if p in self.special else next(inner) for p in parts]
            )
        return out

    def run_tokens(
        self, joined: bytes, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of the words between those bounds end to end, and how many each has. Short
        words go through the memo; long ones are encoded here and forgotten."""
        long = ends - starts > LONG_WORD
        if not long.any():
            return self.memo_tokens_of(joined, starts, ends, hashes)
        short = ~long
        ids, counts = self.memo_tokens_of(joined, starts[short], ends[short], hashes[short])
        _, first, which = np.unique(hashes[long], return_index=True, return_inverse=True)
        spans = zip(starts[long][first].tolist(), ends[long][first].tolist())
        made, sizes = self.encode_words([joined[a:b].decode() for a, b in spans])
        begin = np.cumsum(sizes) - sizes
        many = np.empty(len(hashes), np.int64)
        many[short], many[long] = counts, sizes[which]
        out, of_long = np.empty(int(many.sum()), np.int32), np.repeat(long, many)
        shift = np.repeat(begin[which] - (np.cumsum(sizes[which]) - sizes[which]), sizes[which])
        out[~of_long], out[of_long] = ids, made[shift + np.arange(len(shift))]
        return out, many

    def memo_tokens_of(self, joined: bytes, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = self.places(joined, starts, ends, hashes)
        return self.memo.tokens(place)

    def places(self, joined: bytes, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Places in the memo of the words between those bounds, put there if they are new;
        at most a quarter of `MEMO_WORDS` words, none of them long."""
        place = self.memo.find(hashes)
        new = np.flatnonzero(place < 0)
        keys, first = np.unique(hashes[new], return_index=True)
        if self.memo.held and self.memo.full(len(keys), int((ends - starts)[new[first]].sum())):
            self.memo = Memo()
            return self.places(joined, starts, ends, hashes)
        if len(new):
            of = new[first]
            unknown = [joined[a:b].decode() for a, b in zip(starts[of].tolist(), ends[of].tolist())]
            self.memo.add(keys, *self.encode_words(unknown))
            place[new] = self.memo.find(hashes[new])
        return place

    # -- the transducer

    def encode_pieces(self, pieces: list[str]) -> dict[str, bytes]:
        """Tokens of each piece; pieces beyond a window are emitted window by window."""
        out: dict[str, bytes] = {}
        raw = [p.encode() for p in pieces]
        size = np.array([len(r) for r in raw], np.int64)
        group = np.searchsorted(_WIDTHS, size)
        for g, width in enumerate(_WIDTHS):
            of = np.flatnonzero(group == g)
            for lo in range(0, len(of), max(1, 2_000_000 // width)):
                part = of[lo : lo + max(1, 2_000_000 // width)]
                lanes, lens = self.lanes([raw[i] for i in part], size[part], width)
                lanes[np.arange(len(part)), lens - 1] = self.final[
                    np.frombuffer(b"".join([raw[i][-1:] for i in part]), np.uint8)
                ]
                alive = self.merge(lanes, lens)
                ids = lanes[alive].astype("<u4").tobytes()
                ends = (4 * np.cumsum(alive.sum(1))).tolist()
                start = 0
                for i, end in zip(part.tolist(), ends):
                    out[pieces[i]] = ids[start:end]
                    start = end
        for i in np.flatnonzero(group == len(_WIDTHS)):
            out[pieces[i]] = b"".join(self.stream(raw[i]))
        return out

    def lanes(self, raw: list[bytes], size: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        flat = self.inner[np.frombuffer(b"".join(raw), np.uint8)]
        lanes = np.zeros((len(raw), width), np.int32)
        lanes[np.arange(width) < size[:, None]] = flat
        return lanes, size

    def stream(self, raw: bytes) -> Iterator[bytes]:
        """Tokens of one long piece, each as soon as it is final."""
        at = 0
        while at < len(raw):
            part = raw[at : at + WINDOW]
            lanes, lens = self.lanes([part], np.array([len(part)]), len(part))
            last = at + len(part) == len(raw)
            if last:
                lanes[0, -1] = self.final[part[-1]]
            alive = self.merge(lanes, lens)[0]
            starts = np.flatnonzero(alive)
            ends = np.append(starts[1:], len(part))
            keep = np.ones(len(starts), bool) if last else ends <= len(part) - self.lookahead
            yield lanes[0, starts[keep]].astype("<u4").tobytes()
            at += int(ends[keep][-1])

    def merge(self, lanes: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Merge every lane in place, lowest rank first and leftmost among equals.
        Returns which places still hold a token."""
        n, width = lanes.shape
        place = np.arange(width)
        alive = place < lens[:, None]
        if width < 2:
            return alive
        rank = np.full((n, width), NONE, np.int32)
        pair = place[1:] < lens[:, None]
        rank[:, :-1][pair] = self.pairs.rank(lanes[:, :-1][pair], lanes[:, 1:][pair])
        after = np.broadcast_to(place + 1, (n, width)).astype(np.int16).copy()
        before = np.broadcast_to(place - 1, (n, width)).astype(np.int16).copy()
        row = np.arange(n)
        best = rank.argmin(1)
        low = rank[row, best]
        while True:
            busy = low != NONE
            row, at, low = row[busy], best[busy], low[busy]
            if not len(row):
                return alive
            gone = after[row, at]
            then = after[row, gone]
            lanes[row, at] = self.merged[low]
            alive[row, gone] = False
            rank[row, gone] = NONE
            after[row, at] = then
            rank[row, at] = NONE
            more = then < lens[row]
            r, a, t = row[more], at[more], then[more]
            before[r, t] = a
            rank[r, a] = self.pairs.rank(lanes[r, a], lanes[r, t])
            prior = before[row, at]
            more = prior >= 0
            r, a, p = row[more], at[more], prior[more]
            rank[r, p] = self.pairs.rank(lanes[r, p], lanes[r, a])
            left = rank[row]
            best = left.argmin(1)
            low = left[np.arange(len(row)), best]


class Decoder:
    """Turns token ids back into text piece by piece.

    `library` is what the library's own decode gives for a file without a decoder: the
    tokens with a blank between. `text` maps byte letters back to bytes, ends words with a
    blank and holds back bytes of an unfinished character.
    """

    BLOCK = 1 << 16

    def __init__(self, encoder: Encoder):
        self.names = [t.encode() for t in encoder.tokens]
        to_byte = {c: b for b, c in enumerate(byte_letters())}
        special = set(encoder.special.values())
        self.bytes: list[bytes] = []
        for i, token in enumerate(encoder.tokens):
            if i in special:
                self.bytes.append(token.encode())
                continue
            core = token.removesuffix(encoder.suffix) if encoder.suffix else token
            self.bytes.append(bytes(to_byte[c] for c in core) + (b" " if core != token else b""))

    def library(self, ids: np.ndarray) -> Iterator[bytes]:
        names = self.names
        for lo in range(0, len(ids), self.BLOCK):
            yield (b" " if lo else b"") + b" ".join([names[i] for i in ids[lo : lo + self.BLOCK].tolist()])

    def text(self, ids: np.ndarray) -> Iterator[str]:
        state = codecs.getincrementaldecoder("utf-8")("replace")
        raw = self.bytes
        for lo in range(0, len(ids), self.BLOCK):
            yield state.decode(b"".join([raw[i] for i in ids[lo : lo + self.BLOCK].tolist()]))
        yield state.decode(b"", True)


_encoders: dict[str, Encoder] = {}


def encoder(source: bytes) -> Encoder:
    """The encoder of a vocabulary file, made once per worker."""
    key = hashlib.sha256(source).hexdigest()
    if key not in _encoders:
        _encoders[key] = Encoder(source)
    return _encoders[key]


def vocabulary(path: str) -> bytes:
    """The file's content; read on the driver, so that executors need no copy of the file."""
    with open(path, "rb") as f:
        return f.read()


ENCODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.large_string()), ("text", pa.large_string())])


def encode(docs: DataFrame, path: str, decode: bool = True) -> DataFrame:
    """Encode `text` of every row of `docs` (doc_id, text).

    Returns doc_id, n_tokens, ids (packed little-endian 32-bit numbers), decoded (as the
    library decodes: token names) and text (the bytes that the tokens stand for, put together by
    the state machine); the last two are null if not asked for. One row out for each row in, in the row's own task, no shuffle.
    Null text counts as empty: no tokens, empty `decoded` and `text`. A null doc_id is kept. Repeated
    rows are encoded each. Other columns are dropped. An empty table gives an empty table.
    """
    source = vocabulary(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # many short-lived strings, no cycles
        enc = encoder(source)
        dec = Decoder(enc)
        for b in batches:
            texts = b.column(1)
            for lo, hi in chunks(texts):
                ids = enc.encode_texts(texts.slice(lo, hi - lo).to_pylist())
                names = text = [None] * len(ids)
                if decode:
                    names = [b"".join(dec.library(i)).decode() for i in ids]
                    text = ["".join(dec.text(i)) for i in ids]
                yield batch(
                    ENCODED,
                    doc_id=b.column(0).slice(lo, hi - lo),
                    n_tokens=[len(i) for i in ids],
                    ids=[i.astype("<u4").tobytes() for i in ids],
                    decoded=names,
                    text=text,
                )

    kind = "doc_id LONG, n_tokens LONG, ids BINARY, decoded STRING, text STRING"
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(run, kind)
