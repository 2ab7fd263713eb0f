"""Token ids of whole texts by the tokenizers library, computed once for each distinct chunk.

Both vocabularies cut a text into pre-tokens before they merge, and no pre-token crosses the
chunk borders used here, so the ids of a text are those of its chunks in a row:

* ``words``: chunks lie between ASCII white space, which this kind drops.
* ``bytes``: a single space between two other characters opens a chunk, a single newline is
  a chunk. Texts with any other white space go to the library whole.

The library encodes each chunk that a worker has not met yet; ids are then gathered by
index. What a worker remembers is bounded by MOST_CHUNKS and forgotten beyond.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

MOST_CHUNKS = 600_000
#: A chunk by a digest, which takes a sixth of the room of its text in a dictionary.
DIGEST = np.dtype([("a", "<u8"), ("b", "<u8"), ("place", "<i4")])
#: White space beyond single spaces and newlines, as a pattern over whole texts.
ODD_SPACE = (
    r"[\t\r\f\v\x00\x1c-\x1f]|[ \n][ \n]|\A[ \n]|[ \n]\z|"
    r"[\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

#: Chunks of one word of Latin letters and the punctuation after it: two pre-tokens at most,
#: whose spelling normalisation does not change but for case.
PLAIN = re.compile(r"( ?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")


# This kind of vocabulary cuts a text into these endings behind an apostrophe, runs of
# letters, single digits, and runs of anything else but white space.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
#: White space and what lies between it, as the tokenizers see it.
PIECE = regex.compile(r"(\p{White_Space}+)|\P{White_Space}+")


def byte_letters() -> dict[int, str]:
    """Byte-level vocabularies spell printable bytes as themselves, the others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


LETTERS = byte_letters()


class ChunkEncoder:
    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.bytes_kind = isinstance(self.tokenizer.pre_tokenizer, ByteLevel)
        self.model = self.tokenizer.model
        self.path = path
        self.merges: PrefixMerges | None = None
        self.tables: dict[str, list[int]] = {}
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if not t.normalized]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or r"(?!)")
        self.forget()

    def forget(self) -> None:
        self.marks: dict[str, list[int]] = {}
        #: Where the ids of each chunk begin, and how many there are, by the chunk's place.
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.pool, self.filled = np.zeros(1 << 14, np.uint32), 0
        #: Digests of chunks in order, with the chunks' places: most of them, and the latest.
        self.table, self.latest = np.zeros(0, DIGEST), np.zeros(0, DIGEST)
        self._store(np.zeros((1, 2), np.uint64), np.zeros(0, np.uint32), np.zeros(1, np.int64))  # the empty chunk

    @staticmethod
    def digests(chunks: pa.Array) -> np.ndarray:
        """128 bits for each chunk; none for the empty one."""
        raw = b"".join([xxhash.xxh3_128_digest(c) if c else bytes(16) for c in chunks.cast(pa.binary()).to_pylist()])
        return np.frombuffer(raw, np.uint64).reshape(-1, 2)

    def find(self, digests: np.ndarray) -> np.ndarray:
        """The place of each chunk, -1 if it is not known."""
        out = np.full(len(digests), -1, np.int64)
        for table in (self.table, self.latest):
            if len(table):
                at = np.minimum(np.searchsorted(table["a"], digests[:, 0]), len(table) - 1)
                same = (table["a"][at] == digests[:, 0]) & (table["b"][at] == digests[:, 1])
                out[same] = table["place"][at[same]]
        return out

    def _store(self, digests: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Remember the ids of new chunks."""
        n = len(self.first)
        while self.filled + len(ids) > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros_like(self.pool)))
        self.pool[self.filled : self.filled + len(ids)] = ids
        self.first = np.concatenate((self.first, self.filled + np.cumsum(counts) - counts))
        self.count = np.concatenate((self.count, counts.astype(np.int32)))
        self.filled += len(ids)
        new = np.empty(len(digests), DIGEST)
        new["a"], new["b"], new["place"] = digests[:, 0], digests[:, 1], np.arange(n, n + len(digests))
        latest = np.concatenate((self.latest, new))
        if 4 * len(latest) > len(self.table):
            self.table, latest = np.concatenate((self.table, latest)), latest[:0]
            self.table = self.table[np.argsort(self.table["a"])]
        self.latest = latest[np.argsort(latest["a"])]

    def library(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _word(self, word: str) -> list[int]:
        """The library's merges of one pre-token."""
        spelled = word.replace(" ", LETTERS[32]) if word.isascii() else word.encode().decode("latin-1").translate(LETTERS)
        return [t.id for t in self.model.tokenize(spelled)]

    def _learn(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks in a row, how many each has): plain words by the library's model, others by the whole library.

        The latter are encoded as one text, and each gets the tokens that start in it.
        """
        own: list[list[int]] = [[]] * len(new)
        others = []
        for i, c in enumerate(new):
            m = PLAIN.fullmatch(c)
            if m is None or (m[1] and not self.bytes_kind):
                others.append(i)
                continue
            ids = self._word(m[1] + m[2]) if self.bytes_kind else self._word(m[2].lower())
            if m[3]:
                if m[3] not in self.marks:
                    self.marks[m[3]] = self._word(m[3])
                ids += self.marks[m[3]]
            own[i] = ids
        for at in range(0, len(others), 4000):
            part = others[at : at + 4000]
            rest = [i for i in part if new[i] != "\n"]
            pieces = [c if self.bytes_kind and c[0] == " " else ("\n" if self.bytes_kind else " ") + c for c in (new[i] for i in rest)]
            ends = np.cumsum([len(p) for p in pieces])
            starts = ends - [len(new[i]) for i in rest]
            done = self.tokenizer.encode("".join(pieces), add_special_tokens=False)
            ids = np.array(done.ids, np.uint32)
            begins = np.array([o[0] for o in done.offsets], np.int64)
            owner = np.searchsorted(starts, begins, side="right") - 1
            real = (owner >= 0) & (begins < ends[np.maximum(owner, 0)]) if rest else np.zeros(0, bool)
            ids, owner = ids[real], owner[real]
            borders = np.searchsorted(owner, np.arange(len(rest) + 1)).tolist()
            for k, i in enumerate(rest):
                own[i] = ids[borders[k] : borders[k + 1]].tolist()
            for i in set(part) - set(rest):
                own[i] = self.library(new[i]).tolist()
        counts = np.fromiter(map(len, own), np.int64, len(own))
        return np.fromiter(itertools.chain.from_iterable(own), np.uint32, counts.sum()), counts

    def chunks(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """(place of each chunk among those known, offsets of the texts' chunks, the chunks)."""
        if self.bytes_kind:
            marked = pc.replace_substring(pc.replace_substring(texts, " ", "\x00 "), "\n", "\x00\n\x00")
            split = pc.split_pattern(marked, "\x00")
        else:
            split = pc.ascii_split_whitespace(texts)
        flat, offsets = split.flatten(), split.offsets.to_numpy().astype(np.int64)
        offsets = offsets - offsets[0]
        coded = flat.dictionary_encode()
        distinct = coded.dictionary
        if len(self.first) + len(distinct) > MOST_CHUNKS:
            self.forget()
        digests = self.digests(distinct)
        places = self.find(digests)
        new = np.flatnonzero(places < 0)
        if len(new):
            ids, counts = self._learn(distinct.take(pa.array(new)).to_pylist())
            places[new] = len(self.first) + np.arange(len(new))
            self._store(digests[new], ids, counts)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        return (places[codes] if len(codes) else np.zeros(0, np.int64)), offsets, flat

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; null counts as empty."""
        texts = pc.fill_null(texts, "")
        out: list = [None] * len(texts)
        plain = np.arange(len(texts))
        if self.bytes_kind:
            odd = pc.match_substring_regex(texts, ODD_SPACE).to_numpy(zero_copy_only=False)
            for i in np.flatnonzero(odd):
                out[i] = self.library(texts[int(i)].as_py())
            plain = np.flatnonzero(~odd)
            texts = texts.take(pa.array(plain))
        places, offsets, _ = self.chunks(texts)
        counts = self.count[places].astype(np.int64)
        upto = np.concatenate(([0], np.cumsum(counts)))
        ids = self.pool[np.repeat(self.first[places] - upto[:-1], counts) + np.arange(upto[-1])]
        borders = upto[offsets].tolist()
        for k, i in enumerate(plain.tolist()):
            out[i] = ids[borders[k] : borders[k + 1]]
        return out

    def prefix_counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """(token count of the prefix that ends with each chunk, offsets of the texts, chunks).

        The recurrence over a text's prefixes: what a prefix that ends inside a chunk counts
        is the count at the chunk's start plus the tokens of the chunk's own prefix.
        """
        if self.bytes_kind:
            raise ValueError("prefix counts need a vocabulary that drops white space")
        places, offsets, flat = self.chunks(pc.fill_null(texts, ""))
        upto = np.concatenate(([0], np.cumsum(self.count[places])))
        return upto[1:] - np.repeat(upto[offsets[:-1]], np.diff(offsets)), offsets, flat

    def prefix_table(self, chunk: str) -> list[int]:
        """Tokens of each prefix of a chunk, the empty one first; made once and remembered."""
        table = self.tables.get(chunk)
        if table is None:
            table = self._prefix_table(chunk)
            if len(self.tables) * 16 >= MOST_CHUNKS:
                self.tables.clear()
            self.tables[chunk] = table
        return table

    def _prefix_table(self, chunk: str) -> list[int]:
        """Special strings are tokens by themselves; what lies between them is read piece by piece."""
        out, base, at = [0], 0, 0
        for m in [*self.special.finditer(chunk), None]:
            # prefixes that end inside a special string have its characters as ordinary ones
            end, upto = (m.start(), m.end() - 1) if m else (len(chunk), len(chunk))
            own = self._plain_table(chunk[at:upto])
            out += [base + n for n in own[1:]]
            if m:
                base += own[end - at] + 1
                out.append(base)
                at = m.end()
        return out

    def _plain_table(self, text: str) -> list[int]:
        out, base = [0], 0
        for m in PIECE.finditer(text):
            own = [0] * (len(m[0]) + 1) if m[1] else self._piece_table(m[0])
            out += [base + n for n in own[1:]]
            base += own[-1]
        return out

    def _piece_table(self, piece: str) -> list[int]:
        """Tokens of each prefix of a text without white space and special strings.

        Should the program not come to the library's count, the library counts the prefixes
        of this piece, one by one; none is known for which that is so.
        """
        if self.merges is None:
            with open(self.path, encoding="utf-8") as f:
                self.merges = PrefixMerges(json.load(f)["model"])
        whole = len(self.library(piece))
        try:
            out = PieceCounts(self).table(piece)
            if out[-1] == whole:
                return out
        except ValueError:  # a letter that the vocabulary lacks
            pass
        return [0] + [len(self.library(piece[:i])) for i in range(1, len(piece))] + [whole]


@functools.cache
def joins_before() -> frozenset[str]:
    """Characters that are no combining marks and yet compose with what comes before them."""
    out = {chr(c) for c in [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]}  # vowels and finals of syllable blocks
    for c in range(0x110000):
        parts = unicodedata.decomposition(chr(c)).split()
        if len(parts) == 2 and not parts[0].startswith("<") and not unicodedata.combining(chr(int(parts[1], 16))):
            out.add(chr(int(parts[1], 16)))
    return frozenset(out)


class PieceCounts:
    """The pre-tokens of a piece while its characters come one after the other.

    Characters that normalisation may turn into others together form a cluster; a prefix that
    ends inside one has its characters so far normalised by themselves, which is tried on
    top of what came before and taken back. What came before is never read again, but for an
    apostrophe and one letter that the next letter may make an ending of.
    """

    def __init__(self, encoder: ChunkEncoder) -> None:
        self.encoder, self.merges = encoder, encoder.merges
        self.done, self.kind, self.walk = 0, "", None  # tokens of closed pre-tokens; kind and walk of the open one
        self.text, self.before = "", None  # the open one's first two characters; tokens before an apostrophe that may begin an ending

    def state(self) -> tuple:
        return self.done, self.kind, self.walk, len(self.walk.last) if self.walk else 0, self.text, self.before

    def back(self, state: tuple) -> None:
        self.done, self.kind, self.walk, n, self.text, self.before = state
        if self.walk:
            self.walk.cut(n)

    def count(self) -> int:
        return self.done + (self.walk.ends() if self.walk else 0)

    def _close(self) -> None:
        self.done, self.kind, self.walk, self.text = self.count(), "", None, ""

    def add(self, c: str) -> None:
        kind = {"L": "L", "N": "N"}.get(unicodedata.category(c)[0], "S")
        if kind == "L" and self.before is not None and self.kind == "L" and len(self.text) == 1 and self.text + c in ENDINGS:
            self.done = self.before + len(self.encoder._word("'" + self.text + c))
            self.kind, self.walk, self.text, self.before = "", None, "", None
            return
        if kind == "L" and self.kind == "S" and self.text == "'":
            before = self.done
            if c in ENDINGS:
                self.done = before + len(self.encoder._word("'" + c))
                self.kind, self.walk, self.text, self.before = "", None, "", None
                return
            self._close()
            self.before = before
        elif kind != "L" or self.kind != "L" or len(self.text) > 1:
            self.before = None
        if kind != self.kind or kind == "N":
            self._close()
            self.kind, self.walk = kind, PrefixWalk(self.merges)
        if len(self.text) < 2:
            self.text += c
        for b in c.encode():
            self.walk.push(LETTERS[b])

    def feed(self, cluster: str) -> None:
        for c in unicodedata.normalize("NFC", cluster):
            for x in c.lower():
                self.add(x)

    def table(self, piece: str) -> list[int]:
        out, joins, n = [0], joins_before(), len(piece)
        at = run = same = 0
        while at < n:
            if at >= run:  # marks up to run belong to this character, those from same on are of one class
                run = at + 1
                while run < n and (unicodedata.combining(piece[run]) or piece[run] in joins):
                    run += 1
                same = run - 1
                while same > at and unicodedata.combining(piece[same - 1]) == unicodedata.combining(piece[run - 1]) > 0:
                    same -= 1
            end = run
            for i in range(max(same, at) + 1, run):
                # behind a mark that stays as it is, others of its class can change nothing
                if unicodedata.combining(piece[i - 1]) and unicodedata.normalize("NFC", piece[at:i])[-1] == piece[i - 1]:
                    end = i
                    break
            before = self.state()
            for i in range(at + 1, end):
                self.feed(piece[at:i])
                out.append(self.count())
                self.back(before)
            self.feed(piece[at:end])
            out.append(self.count())
            at = end
        return out


class PrefixMerges:
    """Token counts at every prefix of a pre-token by dynamic programming, without encoding prefixes.

    The last token of a prefix's encoding, taken off, leaves the encoding of the shorter
    prefix; and a token may follow that one's last token exactly if the merges turn the two
    side by side into the two again. So one pass from left to right finds for each prefix the
    only token that can end it, and its count is one more than that of the prefix before it.
    """

    def __init__(self, model: dict) -> None:
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.rank = {(a, b): i for i, (a, b) in enumerate(pairs)}
        self.end = model.get("end_of_word_suffix") or ""
        made = {a + b for a, b in self.rank}
        self.tokens = {t for t in model["vocab"] if t in made or len(t.removesuffix(self.end) or t) == 1}
        #: The letters of the longest token that ends with a letter, or with a letter and the end mark.
        self.reach: dict[str, int] = {}
        for t in self.tokens:
            body = t.removesuffix(self.end) or t
            last = body[-1] + t[len(body) :]
            self.reach[last] = max(self.reach.get(last, 0), len(body))
        self.follows: dict[tuple[str, str], bool] = {}

    def symbols(self, token: str) -> list[str]:
        if self.end and token.endswith(self.end):
            body = token.removesuffix(self.end)
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def merged(self, parts: list[str]) -> list[str]:
        """The merges of one pre-token: again and again the pair of least rank, the leftmost first."""
        while len(parts) > 1:
            rank, i = min((self.rank.get((a, b), len(self.rank)), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == len(self.rank):
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def may_follow(self, before: str, token: str) -> bool:
        known = self.follows.get((before, token))
        if known is None:
            want = [before, token] if before else [token]
            known = self.merged(self.symbols(before) + self.symbols(token)) == want
            if len(self.follows) >= MOST_CHUNKS:
                self.follows.clear()
            self.follows[before, token] = known
        return known


class PrefixWalk:
    """The prefixes of one pre-token, letter by letter: which token ends each that goes on, and its count."""

    def __init__(self, merges: PrefixMerges) -> None:
        self.merges, self.letters, self.last, self.count = merges, [], [""], [0]

    def _found(self, suffix: str) -> tuple[str, int]:
        """(token, count) at the end of what has come, the token with ``suffix``."""
        m, i = self.merges, len(self.letters)
        low = max(0, i - m.reach.get(self.letters[-1] + suffix, 0))
        tail = "".join(self.letters[low:])
        for j in range(low, i):
            token = tail[j - low :] + suffix
            if token in m.tokens and m.may_follow(self.last[j], token):
                return token, self.count[j] + 1
        raise ValueError(f"{self.letters[-1]!r} is a letter that the vocabulary lacks")

    def push(self, letter: str) -> None:
        self.letters.append(letter)
        token, count = self._found("")
        self.last.append(token)
        self.count.append(count)

    def ends(self) -> int:
        """Tokens if the pre-token ends here."""
        return self._found(self.merges.end)[1] if self.letters else 0

    def cut(self, n: int) -> None:
        """Back to where ``last`` had ``n`` entries."""
        del self.last[n:], self.count[n:], self.letters[n - 1 :]


_encoders: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]
