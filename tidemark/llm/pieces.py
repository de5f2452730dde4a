"""Token ids of whole texts as the tokenizers library gives them.

Two families of vocabulary files cut a text at its spaces whatever stands
around them, so equal pieces between spaces always get equal ids:

- ``byte``: byte-level with the library's own pattern, which binds one space
  to the word that follows it;
- ``word``: white space collapsed and dropped, lower-cased, word ends marked.

A text of plain characters alone (ASCII without the apostrophe, Latin letters
with marks, spaces and line feeds) is cut by the family's pattern, which is
simple for them, and its runs go to the library's merge model, once for each
different run that a worker remembers. In other texts ids are remembered by
piece between spaces: a piece of letters with punctuation after it goes to
the merge model, every other piece through the whole library. A file of
another family, and a text with space beside other white space in the byte
family, is encoded whole. Each file's encoder first proves on a few texts that
it gives the library's ids.

:meth:`Encoder.many` does the same for a column of texts at once: in the word
family the runs of all its plain texts are cut as an Arrow array, each
different one is looked up once, and those not yet known go to the library's
merge model together.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import Split

#: Pieces that a worker remembers before it starts anew.
REMEMBERED = 400_000
#: Bytes of the runs of columns, with their ids, that it remembers before.
REMEMBERED_BYTES = 32 << 20
#: Bytes of text that are cut into runs at once (a longer text: by itself),
#: and runs that the library gets at once.
CUT_BYTES = 8 << 20
RUNS_AT_ONCE = 1024

#: Latin letters that have one-character lower case and no decomposed form
#: here, then ASCII punctuation without the apostrophe (it begins endings).
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
#: A text of plain characters, and the runs in it, by family.
_SAFE = re.compile(r"[ \n!-&(-~À-ÖØ-öø-ÿ]*")
_RUNS = {"byte": re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\sA-Za-z0-9À-ÖØ-öø-ÿ]+|\s+(?!\S)|\s+"),
         "word": re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")}
_NEAR = re.compile(r" \s|\s |^\s|\s$")
#: Texts on which the piecewise way must agree with the library at the start.
_PROBES = ("The quick, brown\nfox; is 12 oclock!!  Ünïted straße\n\n ÿ x-y (z) 345 a1b2 %%% ### a|b\n", " \n x", "a <| b", "The quick, brown\nfox; it's 12 o'clock!! Ünïted straße ÿ x-y (z) <|endoftext|> a<|endoftext|>b",
           "one  two\t three\n\nfour ", "", " ", "###&&& word%%% A1b2 ...", "«été» — 北京 İstanbul ǅ")


#: Made as the module loads, as pyarrow loads pandas with its first array and
#: a process keeps that: it is not an encoder's memory.
_NO_RUNS, _NO_IDS = pa.array([], pa.string()), pa.array([], pa.list_(pa.uint32()))
#: What a byte of a plain text belongs to; all white space there ends a run.
_SPACE, _LETTER, _DIGIT, _MARK, _OTHER = range(5)


def _byte_kinds() -> tuple[np.ndarray, np.ndarray]:
    """The kind of each byte, and the byte that stands for it in lower case
    (white space: a space), for UTF-8 texts as ``_SAFE`` has them. A byte of
    any other character is ``_OTHER``, its first byte at least."""
    kinds, lower = np.full(256, _OTHER, np.uint8), np.arange(256, dtype=np.uint8)
    kinds[[*range(33, 39), *range(40, 127)]] = _MARK
    kinds[[10, 32]] = _SPACE
    kinds[48:58] = _DIGIT
    kinds[65:91] = kinds[97:123] = _LETTER
    kinds[0x80:0xC0] = kinds[0xC3] = _LETTER  # Latin letters with marks
    kinds[[0x97, 0xB7]] = _OTHER  # signs of multiplication and division
    lower[10] = 32
    lower[65:91] += 32
    lower[0x80:0x9F] += 32
    return kinds, lower


_KINDS, _LOWER = _byte_kinds()


def _byte_letters() -> str:
    """The letter that stands for each byte: itself where it prints, else the
    next one from code point 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return "".join(chr(b) if b in prints else chr(next(rest)) for b in range(256))


def _family(t: Tokenizer) -> str | None:
    spec = json.loads(t.to_str())
    if spec["model"]["type"] != "BPE" or spec.get("post_processor"):
        return None
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and norm is None:
        return "byte"
    steps = [x["type"] for x in (norm or {}).get("normalizers", [])]
    parts = [x["type"] for x in pre.get("pretokenizers", [])]
    if steps == ["NFC", "Replace", "Lowercase"] and parts == ["Split", "ByteLevel"]:
        return "word"
    return None


class _Known(dict):
    """What a worker remembers; ``make`` gives what it lacks."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, key: str) -> bytes:
        got = self[key] = self.make(key)
        return got


class Encoder:
    """Ids of texts as unsigned 32-bit integers in the machine's order."""

    def __init__(self, path: str):
        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        self.tokenizer, self.model, self.letters = t, t.model, _byte_letters()
        self.vocab = t.get_vocab_size(with_added_tokens=True)
        self.family = _family(t)
        self.space = " " if self.family == "byte" else ""
        self.runs, self.pieces = _Known(self._run), _Known(self._piece)
        self._start_anew()
        self.merges = Tokenizer(self.model)  # words of bytes' letters with spaces between
        self.merges.pre_tokenizer = Split(" ", "removed")
        suffix = getattr(self.model, "end_of_word_suffix", None)
        self.ends = np.zeros(self.vocab, bool)  # the ids that end a word
        if suffix:
            self.ends[[i for x, i in t.get_vocab().items() if x.endswith(suffix) and i < self.vocab]] = True
        if self.family and any(self(x) != self.whole(x) for x in _PROBES):
            self.family = None
        if self.family and b"".join(ids.tobytes() for ids, _ in self.many(pa.array(_PROBES))) != b"".join(map(self.whole, _PROBES)):
            self.family = None

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _run(self, run: str) -> bytes:
        """The ids of what the library's pattern takes as one word."""
        if run.isascii():
            name = run.replace(" ", self.letters[32]).replace("\n", self.letters[10])
        else:
            name = run.encode().decode("latin-1").translate(self.letters)
        return array("I", [x.id for x in self.model.tokenize(name)]).tobytes()

    def _piece(self, piece: str, space: str | None = None) -> bytes:
        space = self.space if space is None else space
        plain = _PLAIN.fullmatch(piece)
        if plain:
            word, marks = plain.groups()
            word = self.runs[space + word if self.family == "byte" else word.lower()]
            return word + self.runs[marks] if marks else word
        if "\n" in piece:
            first, *lines = piece.split("\n")
            if _PLAIN.fullmatch(first) and all(map(_PLAIN.fullmatch, lines)):
                return self._piece(first, space) + b"".join([self.runs["\n"] + self._piece(x, "") for x in lines])
        return self.whole(space + piece) if piece or space else b""

    def __call__(self, text: str) -> bytes:
        if self.family is None:
            return self.whole(text)
        if len(self.pieces) > REMEMBERED or len(self.runs) > REMEMBERED:
            self.pieces.clear()
            self.runs.clear()
        if _SAFE.fullmatch(text) and "<|" not in text:
            runs = _RUNS[self.family].findall(text.lower() if self.family == "word" else text)
            return b"".join(map(self.runs.__getitem__, runs))
        if self.family == "word":
            return b"".join(map(self.pieces.__getitem__, text.replace("\n", " ").split(" ")))
        if not text or _NEAR.search(text):
            return self.whole(text)
        first, *words = text.split(" ")
        return self._piece(first, "") + b"".join(map(self.pieces.__getitem__, words))

    def _start_anew(self) -> None:
        """Let go of the runs of columns, and of their ids beside them."""
        self.known, self.known_ids = _NO_RUNS, _NO_IDS

    def _merged(self, runs: list[str]) -> pa.ListArray:
        """The ids of many runs. The library gets some at once; where its ids
        do not tell the words' ends it gets these runs one by one."""
        flat, sizes = [], []
        for i in range(0, len(runs), RUNS_AT_ONCE):
            some = runs[i:i + RUNS_AT_ONCE]
            text = "\n".join(some).encode().decode("latin-1").translate(self.letters).replace(self.letters[10], " ")
            ids = np.array(self.merges.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.ends[ids])
            if len(ends) == len(some) and ends[-1] == len(ids) - 1:
                sizes.append(np.diff(ends, prepend=-1))
            else:
                one = [self._run(x) for x in some]
                ids = np.frombuffer(b"".join(one), np.uint32)
                sizes.append(np.array([len(x) // 4 for x in one], np.int64))
            flat.append(ids)
        offsets = np.concatenate([[0], *map(np.cumsum, [np.concatenate([np.zeros(0, np.int64), *sizes])])])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.uint32), *flat])))

    def _cut(self, texts: pa.Array, tail: bytes) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`many` for a few texts of the word family."""
        bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
        held = texts.buffers()[2]
        data = np.frombuffer(held, np.uint8)[bounds[0]:bounds[-1]] if held else np.zeros(0, np.uint8)
        bounds = bounds - bounds[0]
        kinds = _KINDS[data]
        opened = np.flatnonzero(data[:-1] == ord("<"))
        other = np.concatenate([np.flatnonzero(kinds == _OTHER), opened[data[opened + 1] == ord("|")]])
        whole = np.unique(np.searchsorted(bounds[1:], other, "right"))  # texts that are not plain
        if len(whole):
            sizes = np.diff(bounds)
            plain = np.ones(len(texts), bool)
            plain[whole] = False
            kept = np.repeat(plain, sizes)
            data, kinds = data[kept], kinds[kept]
            bounds = np.concatenate([[0], np.cumsum(sizes * plain)])
        last = kinds == _DIGIT  # the last byte of a run
        last[:-1] |= kinds[1:] != kinds[:-1]
        last[bounds[1:][bounds[1:] > 0] - 1] = True
        last &= kinds != _SPACE
        last = np.flatnonzero(last).astype(np.int32) + np.int32(1)
        # a run as an Arrow string has the white space before it
        runs = pa.StringArray.from_buffers(len(last), pa.py_buffer(np.concatenate([np.zeros(1, np.int32), last])), pa.py_buffer(_LOWER[data]))
        coded = runs.dictionary_encode()
        del data, kinds, runs
        places = pc.index_in(coded.dictionary, value_set=self.known)
        missing, places = places.is_null().to_numpy(zero_copy_only=False), places.fill_null(0).to_numpy()
        if missing.any():
            new = coded.dictionary.filter(pa.array(missing))
            if self.known.nbytes + self.known_ids.nbytes + new.nbytes > REMEMBERED_BYTES:
                self._start_anew()
                new, missing = coded.dictionary, np.ones(len(missing), bool)
            places = np.where(missing, len(self.known) + np.cumsum(missing) - 1, places)
            self.known_ids = pa.concat_arrays([self.known_ids, self._merged(pc.utf8_ltrim(new, characters=" ").to_pylist())])
            self.known = pa.concat_arrays([self.known, new])
        codes = places.astype(np.int32)[coded.indices.to_numpy()]
        # a text that is not plain, and the tail of each, are one more run each
        more = [np.frombuffer(x, np.uint32) for x in [self(texts[i].as_py()) for i in whole.tolist()] + [tail]]
        n = len(self.known)
        all_ids = pa.concat_arrays([self.known_ids, pa.array(more, pa.list_(pa.uint32()))])
        ends = np.searchsorted(last, bounds[1:], "right")  # runs up to each text's end
        at = np.concatenate([whole, np.arange(len(texts))])
        order = np.argsort(at, kind="stable")
        added = np.concatenate([n + np.arange(len(whole)), np.full(len(texts), n + len(whole))])
        codes = np.insert(codes, ends[at[order]], added[order])
        got = all_ids.take(pa.array(codes))
        ends += np.cumsum(np.bincount(at, minlength=len(texts)))
        return got.values.to_numpy(), np.diff(got.offsets.to_numpy()[ends], prepend=0).astype(np.int64)

    def many(self, texts: pa.Array, tail: bytes = b"") -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of all texts (no nulls), each followed by those in
        ``tail``, and how many each has, some texts at once."""
        texts = texts.cast(pa.string())
        ends, since = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64)), 0
        while since < len(texts):
            before = ends[since - 1] if since else 0
            until = max(since + 1, int(np.searchsorted(ends, before + CUT_BYTES, "right")))
            some, since = texts.slice(since, until - since), until
            if self.family == "word":
                yield self._cut(some, tail)
            else:
                ids = [self(x) + tail for x in some.to_pylist()]
                yield np.frombuffer(b"".join(ids), np.uint32), np.array([len(x) // 4 for x in ids], np.int64)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """A worker's encoder for a vocabulary file."""
    return Encoder(path)


def give_back() -> None:
    """Give what a worker has freed back to the machine: of many small pieces,
    the C library would keep nearly all."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


def forget() -> None:
    """Let go of a worker's encoders and all that they remember. An encoder
    and its memory refer to each other, so that only a collection frees them."""
    if encoder.cache_info().currsize:
        encoder.cache_clear()
        give_back()
