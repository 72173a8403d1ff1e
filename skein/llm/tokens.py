"""Byte-level BPE token ids of whole texts through the ``tokenizers`` library.

The byte-level pre-tokenizer cuts a text into pieces, and BPE never merges across
pieces, so a column of texts needs each different piece of a batch encoded only
once. Cutting is simple for ordinary text and done on the bytes of all texts at
once: a single space belongs to what follows it, and a run of letters, of digits
or of marks and a lone line feed are pieces; these go straight to the library's BPE
model. A word (between spaces) with any other character, such as an apostrophe, is
not cut and goes through the library's whole encoder, and so does a whole text in
which blanks meet.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

DEFAULT_VOCABULARY = "byte_bpe_50k.json"
TEXT_BYTES = 8 << 20       # text taken together for one list of pieces
KEPT_PIECES = 200_000      # pieces whose ids a worker keeps between batches
IDS = np.dtype("<u4")

# Kinds of bytes. C3-C9 lead the letters U+00C0 to U+024F (but for two signs), which
# are letters in every Unicode version; any other lead byte makes a word special.
SPACE, LETTER, DIGIT, MARK, FEED, OTHER = range(6)
_KIND = np.full(256, OTHER, dtype=np.uint8)
_KIND[32], _KIND[10] = SPACE, FEED
_KIND[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), *range(0xC3, 0xCA)]] = LETTER
_KIND[48:58] = DIGIT
_KIND[list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")] = MARK
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[*range(9, 14), *range(28, 33)]] = True
_BLANK_LEAD = np.zeros(256, dtype=bool)
_BLANK_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_SIGNS = (0x97, 0xB7)       # after C3: the multiplication and division signs

_ENCODERS: dict[str, "Encoder"] = {}


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def encoder(path: str | None = None) -> "Encoder":
    """The encoder of a vocabulary file (default: the public 50k byte-level
    BPE), loaded once per Python worker."""
    path = path or vocabulary_path()
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _gather(table: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """table[s:s+n] for every (s, n), put together."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total, dtype=np.int64)
    at += np.repeat(starts - (ends - lens), lens)
    return table[at]


def _byte_symbols() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others for code points from 256 on."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in keep]
    return {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self._symbols = _byte_symbols()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._known: dict[bytes, bytes] = {}
        self._feeds: dict[int, np.ndarray] = {}

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=IDS)

    def column(self, texts: pa.Array) -> "Encoded":
        """Encode a string column; null counts as empty."""
        return Encoded(self, texts)

    def _line_feeds(self, n: int) -> np.ndarray:
        if n not in self._feeds:
            if len(self._feeds) > 1000:
                return self.whole("\n" * n)
            self._feeds[n] = self.whole("\n" * n)
        return self._feeds[n]

    def pieces(self, pieces: list[bytes], special: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces put together, and how many each has."""
        ids = list(map(self._known.get, pieces))
        tokenize, symbols, room = self.tokenizer.model.tokenize, self._symbols, KEPT_PIECES - len(self._known)
        for i, known in enumerate(ids):
            if known is not None:
                continue
            piece = pieces[i]
            if special[i]:
                ids[i] = self.whole(piece.decode()).tobytes()
                continue
            ids[i] = array("I", [t.id for t in tokenize(piece.decode("latin-1").translate(symbols))]).tobytes()
            if room > 0:
                self._known[piece] = ids[i]
                room -= 1
        lens = np.fromiter(map(len, ids), np.int64, len(ids)) // IDS.itemsize
        return np.frombuffer(b"".join(ids), dtype=IDS), lens


def blanks(data: np.ndarray) -> np.ndarray:
    """Which bytes are of blank characters (Unicode's, and the control characters
    that some call blank)."""
    out = _BLANK[data]
    at = np.flatnonzero(_BLANK_LEAD[data[:-1]]) if len(data) else np.zeros(0, np.int64)
    second = data[at + 1]
    two = at[(data[at] == 0xC2) & ((second == 0x85) | (second == 0xA0))]
    out[two] = out[two + 1] = True
    at = at[at + 2 < len(data)]
    a, b, c = data[at], data[at + 1], data[at + 2]
    three = at[((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
               | ((a == 0xE2) & (b == 0x81) & (c == 0x9F))
               | ((a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)))]
    for k in range(3):
        out[three + k] = True
    return out


def cut(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cut texts, put together as UTF-8 bytes with their bounds ``rows``: the first
    byte of every piece, whether it is of a special word, whether a text has a space
    that meets a blank and must be encoded whole, and which bytes are blank."""
    n, n_rows = len(data), len(rows) - 1
    whole = np.zeros(n_rows, dtype=bool)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, bool), whole, np.zeros(0, bool)
    kind = _KIND[data]
    first = np.zeros(n + 1, dtype=bool)
    first[rows] = True              # of a text (or the end)
    last = first[1:]
    first = first[:-1]
    space, feed = kind == SPACE, kind == FEED
    blank = blanks(data)
    after = np.append(blank[1:], False) & ~last
    before = np.append(False, blank[:-1]) & ~first
    meet = space & (after | before | last)
    if meet.any():
        whole[np.searchsorted(rows, np.flatnonzero(meet), side="right") - 1] = True
    word = first | space
    start = word.copy()
    start[1:] |= (kind[1:] != kind[:-1]) & ~space[:-1]
    odd = kind == OTHER
    odd[:-1] |= (data[:-1] == 0xC3) & ((data[1:] == _SIGNS[0]) | (data[1:] == _SIGNS[1]))
    odd |= feed & (after | before)  # several line feeds
    at = np.flatnonzero(odd)
    special = np.zeros(n, dtype=bool)
    if len(at):
        words = np.flatnonzero(word)
        no = np.unique(np.searchsorted(words, at, side="right") - 1)
        ends = np.append(words[1:], n)
        mark = np.zeros(n + 1, dtype=np.int8)
        mark[words[no]] += 1
        mark[ends[no]] -= 1
        special = np.cumsum(mark[:-1], dtype=np.int8).view(bool)
        start &= word | ~special
    pieces = np.flatnonzero(start)
    return pieces, special[pieces], whole, blank


class Encoded:
    """The ids of a column of texts, given out for ranges of rows."""

    def __init__(self, enc: Encoder, texts: pa.Array):
        texts = pa.concat_arrays([pc.fill_null(texts.cast(pa.large_string()), "")])
        body = pc.utf8_rtrim(texts, "\n")
        self.feeds = (pc.binary_length(texts).to_numpy(zero_copy_only=False)
                      - pc.binary_length(body).to_numpy(zero_copy_only=False))
        _, offsets, buffer = body.buffers()
        rows = np.frombuffer(offsets, np.int64, len(body) + 1) if len(body) else np.zeros(1, np.int64)
        buffer = buffer or pa.py_buffer(b"")
        data = np.frombuffer(buffer, np.uint8, int(rows[-1]))
        starts, special, odd, blank = cut(data, rows)
        # blanks before the line feeds at the end would be one piece with them
        some = np.flatnonzero((self.feeds > 0) & (np.diff(rows) > 0))
        odd[some] |= blank[rows[some + 1] - 1]
        for token in enc.added:         # the whole encoder finds these before it cuts
            odd |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False).astype(bool)
        bounds = np.append(starts, len(data)).astype(np.int64)
        column = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), buffer])
        coded = column.dictionary_encode()
        self.codes = coded.indices.to_numpy(zero_copy_only=False)
        n = len(coded.dictionary)
        table, self.lens = enc.pieces(coded.dictionary.to_pylist(),
                                      np.bincount(self.codes, special, n) > 0 if n else special)
        self.table, self.starts = table, np.cumsum(self.lens) - self.lens
        self.at = np.searchsorted(starts, rows)         # each row's first piece
        self.enc, self.texts, self.odd = enc, texts, odd

    def __len__(self) -> int:
        return len(self.texts)

    def rows(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of rows lo..hi put together, the hi-lo+1 offsets of the rows)."""
        lens = self.lens[self.codes[self.at[lo]:self.at[hi]]]
        sums = np.concatenate([[0], np.cumsum(lens)])
        bounds = sums[self.at[lo:hi + 1] - self.at[lo]]
        ids = _gather(self.table, self.starts[self.codes[self.at[lo]:self.at[hi]]], lens)
        if not (self.odd[lo:hi].any() or self.feeds[lo:hi].any()):
            return ids, bounds
        parts, ends = [], [0]
        for i in range(lo, hi):
            if self.odd[i]:
                part = self.enc.whole(self.texts[i].as_py())
            else:
                part = ids[bounds[i - lo]:bounds[i - lo + 1]]
                if self.feeds[i]:
                    part = np.concatenate([part, self.enc._line_feeds(int(self.feeds[i]))])
            parts.append(part)
            ends.append(ends[-1] + len(part))
        return np.concatenate(parts), np.array(ends)

    def __iter__(self):
        """The ids of every row, in turn."""
        step = 500
        for lo in range(0, len(self), step):
            hi = min(lo + step, len(self))
            ids, bounds = self.rows(lo, hi)
            for i in range(hi - lo):
                yield ids[bounds[i]:bounds[i + 1]]
