"""Text to token ids with the tokenizers library, each different chunk between spaces once.

Both vocabularies split a text before they merge bytes, and no token crosses a space that stands
before a printing character. A text's ids are therefore the ids of its space-led chunks, joined; and
those of a plain chunk are the ids of its runs of letters and of other characters. So are those of two
plain chunks with the end of a line between them. Anything else goes through the whole tokenizer.

Arrow finds the different chunks of some texts and takes plain ones apart; their ids are put together from
those of their parts, and the texts' from those of their chunks, by numpy. A worker lives as long as its executor
and keeps what it has encoded: parts in arrays, as objects would take several times the memory, and of
whole chunks only those that come up again and again.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

ENCODED_CHARS = 4 << 20  # of text that are best encoded together
CACHE_WORDS, CACHE_PARTS = 400_000, 50_000
PART_BYTES = 32 << 20  # of the parts held
CACHE_BYTES = 16 << 20  # of the chunks held, each with ENTRY_BYTES beside its characters and ids
ENTRY_BYTES = 200
OFTEN = 4  # times in the texts of a call, at least, for a chunk to be remembered
_LETTERS = "A-Za-zÀ-ÖØ-öø-įĲ-ſ"
_ODD_SPACE = re.compile(r" (?![!-~¡-ɏ])")
_SPLIT = re.compile(r" (?=[!-~¡-ɏ])")
#: Letters, then other characters: without an apostrophe, which may bind letters to itself, and
#: without white space in a row.
_PLAIN = re.compile(rf"([{_LETTERS}]+)((?:[ -&(-@\[-`{{-~]|\n(?!\s))*)")
#: The characters of plain chunks without a line end.
_EACH_LETTER = "".join(c for c in map(chr, range(0x180)) if re.match(f"[{_LETTERS}]", c))
_EACH_MARK = "".join(c for c in map(chr, range(0x80)) if re.match(r"[ -&(-@\[-`{-~]", c))
#: A plain chunk that ends a line, and right behind it one that begins the next: white space but the one
#: line end would bind to it.
_LINES = re.compile(rf"([{_LETTERS}]+)([!-&(-@\[-`{{-~]*\n)([{_LETTERS}]+)((?:[ -&(-@\[-`{{-~]|\n(?!\s))*)")
_JOINED = 300
_BLOCK = 1 << 18
_STRINGS = pa.large_string()


def _picked(ids: np.ndarray, bounds: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches `pick` of `ids`, one after another, and the length of each."""
    sizes = np.diff(bounds)[pick]
    out, done = np.empty(int(sizes.sum()), ids.dtype), 0
    for k in range(0, len(pick), _BLOCK):
        own = sizes[k : k + _BLOCK]
        ends = np.cumsum(own)
        at = np.arange(ends[-1])
        at += np.repeat(bounds[pick[k : k + _BLOCK]] - ends + own, own)
        out[done : done + len(at)] = ids[at]
        done += len(at)
    return out, sizes


def _objects(strings: pa.Array) -> list[str]:
    """What to_pylist gives, in a tenth of its time."""
    return strings.to_numpy(zero_copy_only=False).tolist()


def _bounds(sizes: np.ndarray) -> np.ndarray:
    return np.append(0, np.cumsum(sizes, dtype=np.int64))


class Parts:
    """Strings with their ids in arrays, some 40 bytes a word. `learn` gives the ids of new ones, joined, and their numbers."""

    def __init__(self, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int):
        self.learn, self.most = learn, most
        self.strings = pa.array([], _STRINGS)
        self.ids, self.bounds, self.uses = np.zeros(0, "<u4"), np.zeros(1, np.int64), np.zeros(0, np.int32)

    def __len__(self) -> int:
        return len(self.strings)

    def __iter__(self) -> Iterator[str]:
        return iter(_objects(self.strings))

    def of(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different strings, joined, and their numbers."""
        at = pc.index_in(strings, value_set=self.strings)
        new = at.is_null()
        at = at.fill_null(0).to_numpy().astype(np.int64)
        if pc.any(new).as_py():
            added = strings.filter(new)
            at[new.to_numpy(zero_copy_only=False)] = len(self) + np.arange(len(added))
            ids, sizes = self.learn(_objects(added))
            self.strings = pa.concat_arrays([self.strings, added])
            self.ids = np.concatenate([self.ids, ids])
            self.bounds = np.append(self.bounds, self.bounds[-1] + np.cumsum(sizes))
            self.uses = np.append(self.uses, np.zeros(len(added), np.int32))
        self.uses[at] += 1
        return _picked(self.ids, self.bounds, at)

    def settle(self) -> None:
        """If there are too many, the half that was asked for most often stays; long ones go."""
        if len(self) <= self.most and self.strings.nbytes + self.ids.nbytes <= PART_BYTES:
            return
        kept = np.argsort(-self.uses, kind="stable")[: self.most // 2]
        kept = np.sort(kept[pc.binary_length(self.strings).to_numpy()[kept] < ENTRY_BYTES])
        self.ids, sizes = _picked(self.ids, self.bounds, kept)
        self.strings, self.bounds, self.uses = self.strings.take(pa.array(kept)), _bounds(sizes), self.uses[kept] // 2


class Encoder:
    """`spaced`: a chunk's token holds the space before it, as in byte-level vocabularies; else white
    space and case are dropped. Strings of special tokens in a text are ordinary text."""

    def __init__(self, path: str, spaced: bool):
        # a task has a core; the library's own threads cost more than they save on short chunks
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        model = Tokenizer.from_file(path).model
        model._resize_cache(0)  # what has been encoded is kept here
        self.bare = Tokenizer(model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        words = self.bare.get_vocab()
        edge = (lambda t: t.startswith("Ġ")) if spaced else (lambda t: t.endswith("</w>"))
        self.edges = np.zeros(max(words.values()) + 1, bool)  # a word's first token, or its last
        self.edges[[i for t, i in words.items() if edge(t)]] = True
        self.spaced = spaced
        self.lead = " " if spaced else ""
        self.letters = {chr(b): c for b, c in enumerate(_byte_letters())}
        self.known: dict[str, bytes] = {}
        self.held = 0
        self.words = Parts(self._word_ids, CACHE_WORDS)
        self.tails = Parts(self._text_ids, CACHE_PARTS)
        self.openings = Parts(self._text_ids, CACHE_PARTS)  # words without a space before them

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if not texts:
            return []
        if not self.spaced:
            texts = [t.replace("\n", " ") for t in texts]
        odd = np.array([bool(_ODD_SPACE.search(t)) for t in texts])
        order = np.argsort(odd, kind="stable").tolist()
        n = len(texts) - int(odd.sum())
        split = pc.split_pattern(pa.array([texts[k] for k in order[:n]], _STRINGS), " ")
        if n < len(texts):
            split = pa.concat_arrays([split, pa.array([_SPLIT.split(texts[k]) for k in order[n:]], split.type)])
        ends, parts = split.offsets.to_numpy(), split.flatten()
        pick = np.empty(len(parts), np.int32)
        inner = np.ones(len(parts), bool)
        if self.spaced:
            inner[ends[:-1]] = False  # a text's first chunk has no space before it
        pick[inner], *found = self._found(parts.filter(pa.array(inner)))
        heads = parts.filter(pa.array(~inner)).dictionary_encode()
        pick[~inner] = heads.indices.to_numpy() + len(found[1])
        ids, sizes = map(np.concatenate, zip(found, self._text_ids(_objects(heads.dictionary))))
        ids, sizes = _picked(ids, _bounds(sizes), pick)
        data, cuts = ids.tobytes(), (4 * _bounds(sizes)[ends]).tolist()
        out: list[bytes] = [b""] * len(texts)
        for k, a, b in zip(order, cuts, cuts[1:]):
            out[k] = data[a:b]
        for held in (self.words, self.tails, self.openings):
            held.settle()
        return out

    def rest(self) -> None:
        """Lets go of the chunks between tasks; the words, from which they are soon put together, stay."""
        self.known.clear()
        self.held = 0

    def _found(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every chunk its place among the different ones; the ids of these, joined, and their numbers.

        Chunks that come up again and again are remembered.
        """
        parts = parts.dictionary_encode()
        pick, chunks = parts.indices.to_numpy(), _objects(parts.dictionary)
        found = list(map(self.known.get, chunks))
        new = [k for k, ids in enumerate(found) if ids is None]
        held = [ids for ids in found if ids is not None]
        learned, sizes = self._learned(parts.dictionary.take(pa.array(new, pa.int64())))
        ids = np.concatenate([np.frombuffer(b"".join(held), "<u4"), learned])
        sizes = np.concatenate([np.array([len(x) // 4 for x in held], np.int64), sizes])
        place = np.zeros(len(chunks), np.int32)  # known ones come first
        place[new] = len(chunks)
        place = np.argsort(place, kind="stable")
        counts = np.bincount(pick, minlength=len(chunks))[place]
        cuts = 4 * _bounds(sizes)

        def remember(rows: np.ndarray, most: int) -> None:
            for k, at, a, b in zip(rows.tolist(), place[rows].tolist(), cuts[rows].tolist(), cuts[rows + 1].tolist()):
                size = ENTRY_BYTES + len(chunks[at]) + b - a
                if len(chunks[at]) < ENTRY_BYTES and self.held + size <= most:
                    self.known[chunks[at]] = ids[a // 4 : b // 4].tobytes()
                    self.held += size

        often = np.flatnonzero(counts >= OFTEN)
        remember(often[often >= len(held)], CACHE_BYTES)
        if self.held > CACHE_BYTES - CACHE_BYTES // 8:  # full: those of these texts stay
            self.rest()
            remember(often[np.argsort(-counts[often], kind="stable")], CACHE_BYTES // 2)
        row = np.empty(len(chunks), np.int32)
        row[place] = np.arange(len(chunks))
        return row[pick], ids, sizes

    def _each(self, texts: set[str]) -> dict[str, bytes]:
        texts = list(texts)
        encoded = self.whole.encode_batch_fast(texts, add_special_tokens=False)
        ids = [x.ids for x in encoded]
        data = np.array(list(itertools.chain.from_iterable(ids)), dtype="<u4").tobytes()
        cuts = [0, *itertools.accumulate(4 * len(x) for x in ids)]
        return {t: data[a:b] for t, a, b in zip(texts, cuts, cuts[1:])}

    def _text_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self._each(texts)
        data = [found[t] for t in texts]
        return np.frombuffer(b"".join(data), "<u4"), np.array([len(d) // 4 for d in data], np.int64)

    def _learned(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different chunks, joined, and their numbers."""
        stems, ends = pc.utf8_rtrim(chunks, characters=_EACH_MARK), pc.utf8_ltrim(chunks, characters=_EACH_LETTER)
        size, stem, end = (pc.binary_length(x).to_numpy() for x in (chunks, stems, ends))
        easy = (stem > 0) & (stem + end == size)  # letters, then marks
        plain, lines, odd = [], [], []
        for k, chunk in zip(np.flatnonzero(~easy).tolist(), _objects(chunks.filter(pa.array(~easy)))):
            if m := _PLAIN.fullmatch(chunk):
                plain.append((k, *m.groups()))
            elif m := _LINES.fullmatch(chunk):
                lines.append((k, *m.groups()))
            else:
                odd.append((k, self.lead + chunk))
        # a chunk has up to four parts, each a row of the table; row 0 is empty
        place, tables = np.zeros((len(chunks), 4), np.int64), [(np.zeros(0, "<u4"), np.zeros(1, np.int64))]

        def put(strings: pa.Array, rows: list, column: int, ids_of: Callable) -> None:
            strings = strings.dictionary_encode()
            place[rows, column] = strings.indices.to_numpy() + sum(len(sizes) for _, sizes in tables)
            tables.append(ids_of(strings.dictionary))

        at = np.flatnonzero(easy).tolist()
        easy = pa.array(easy)
        for column, (more, held) in enumerate([(stems, self.words), (ends, self.tails), (None, self.openings), (None, self.tails)]):
            own = (plain if column < 2 else []) + lines
            some = pa.array([row[column + 1] for row in own], _STRINGS)
            rows = [row[0] for row in own]
            if more:
                some, rows = pa.concat_arrays([more.filter(easy), some]), at + rows
            if rows:
                put(some, rows, column, held.of)
        if odd:
            rows, some = zip(*odd)
            put(pa.array(some, _STRINGS), list(rows), 0, lambda x: self._text_ids(_objects(x)))
        ids, sizes = (np.concatenate(x) for x in zip(*tables))
        ids, sizes = _picked(ids, _bounds(sizes), place.ravel())
        return ids, sizes.reshape(-1, 4).sum(axis=1)

    def _word_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A word is a single piece to the vocabulary: the bare model takes it as it is."""
        plain = words if self.spaced else map(str.lower, words)
        table = self.letters | {"\n": " "}
        mapped = "\n".join(self.lead + w for w in plain).encode().decode("latin-1").translate(str.maketrans(table)).split(" ")
        joined = [" ".join(mapped[at : at + _JOINED]) for at in range(0, len(mapped), _JOINED)]
        encoded = self.bare.encode_batch_fast(joined, add_special_tokens=False)
        ids = np.array([i for x in encoded for i in x.ids], dtype="<u4")
        edges = np.flatnonzero(self.edges[ids])
        if len(edges) != len(words):
            raise ValueError("a word's tokens can't be told from its neighbours'")
        return ids, np.diff(np.append(edges, len(ids)) if self.spaced else np.append(0, edges + 1))


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printing Latin-1 characters
    stand for themselves, the others for the characters from U+0100 on, in order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in own else next(spare)) for b in range(256)]


@functools.cache
def encoder(path: str, spaced: bool) -> Encoder:
    """One for each worker process."""
    return Encoder(path, spaced)


def vocabulary(name: str) -> str:
    """The place of an installed public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)
