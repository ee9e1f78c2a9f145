"""Encoding texts chunk by chunk, with a bounded cache of chunks.

A chunk is what lies between two spaces that have a non-blank character on both sides. A byte-level pattern (words with
their leading space) always starts a new match at such a space, and a pattern that drops blanks never matches across
it, so the ids of a text are the ids of its chunks, one after another. Nothing is cut by length.

Where the pattern drops blanks and tells letters, digits and marks apart, chunks are cut further, to pieces, by tables of
bytes and for many texts at once (``PieceEncoder``).
"""

from __future__ import annotations

import os
from collections.abc import Callable
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHED_CHUNKS = 700_000


def split_chunks(text: str) -> list[str]:
    """The chunks of a text in order; every chunk but the first keeps the space before it. They concatenate to the text."""
    out: list[str] = []
    run: list[str] = []
    last = ""  # the last character so far
    for i, part in enumerate(text.split(" ")):
        if i and last and not last.isspace() and part and not part[0].isspace():
            out.append("".join(run))
            run = []
        if i:
            run.append(" ")
            last = " "
        if part:
            run.append(part)
            last = part[-1]
    out.append("".join(run))
    return out


class ChunkEncoder:
    """Texts to ids as little-endian uint32 bytes.

    ``encode_many`` gets distinct chunks (with their leading space) and returns the ids of each as such bytes. The cache
    holds regular chunks only, in two halves: a full half becomes the old one, whose chunks move over when they are met
    again, and the old one before it is dropped. So common chunks outlast the rare ones.
    """

    def __init__(self, encode_many: Callable[[list[str]], list[bytes]], limit: int = CACHED_CHUNKS):
        self.encode_many, self.limit = encode_many, limit
        self.cache: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        parts = text.split(" ")
        head = parts[0]
        if not head or head[-1].isspace():
            return self._irregular(text)
        rest = parts[1:]
        found = list(map(self.cache.get, rest))
        if None in found:
            missing = list({p for p, f in zip(rest, found) if f is None})
            if "" in missing or list(map(str.strip, missing)) != missing:  # blanks that belong to no single word
                return self._irregular(text)
            new = self._looked_up(missing)
            found = [new[p] if f is None else f for p, f in zip(rest, found)]
        return self.encode_many([head])[0] + b"".join(found)

    @staticmethod
    def chunk(word: str) -> str:
        return " " + word

    def _looked_up(self, missing: list[str]) -> dict[str, bytes]:
        """The ids of words that the newer half lacks; they are in it afterwards."""
        known = dict(zip(missing, map(self.old.get, missing)))
        fresh = [p for p, f in known.items() if f is None]
        if fresh:
            known.update(zip(fresh, self.encode_many(list(map(self.chunk, fresh)))))
        if 2 * (len(self.cache) + len(known)) > self.limit:
            self.old, self.cache = self.cache, {}
        self.cache.update(known)
        return known

    def _irregular(self, text: str) -> bytes:
        chunks = split_chunks(text)
        new = list(dict.fromkeys(chunks))
        ids = dict(zip(new, self.encode_many(new)))
        return b"".join(map(ids.__getitem__, chunks))


BLANKS = b"\t\n\x0b\x0c\r "
TEXT_END = b"\xff"  # in no UTF-8 text


def piece_tables() -> tuple[bytes, bytes]:
    """Bits by byte, of the byte before and of the byte after a place: a piece goes on there if the two share a bit.

    Blanks lead a piece, runs of ASCII letters and of ASCII marks are pieces, and so is every ASCII digit. Apostrophes, control
    bytes and bytes of other characters, of which the byte alone says too little, stay with whatever stands beside them but blanks.
    """
    blank, letter, mark, before_digit, after_digit = 1, 2, 4, 8, 16
    any_before, any_after = letter | mark | after_digit, letter | mark | before_digit
    before, after = [any_before] * 256, [any_after] * 256
    for byte in range(128):
        if byte in BLANKS:
            before[byte], after[byte] = blank | any_after, blank
        elif chr(byte).isalpha():
            before[byte] = after[byte] = letter
        elif chr(byte).isdigit():
            before[byte], after[byte] = after_digit, before_digit
        elif chr(byte).isprintable() and chr(byte) != "'":
            before[byte] = after[byte] = mark
    before[TEXT_END[0]] = after[TEXT_END[0]] = 0
    return bytes(before), bytes(after)


class PieceEncoder(ChunkEncoder):
    """Many texts at once to ids as little-endian uint32 bytes, each text's ids with ``end`` after them, for ``words`` vocabularies.

    A piece is one or more whole matches of the pattern with the blanks before them. Arrow numbers the distinct pieces of
    the texts, only those are looked up, and their ids are taken by number. Capital ASCII letters are made small first, as the
    normaliser does, unless there may be a combining mark: some compose with small letters only.
    """

    def __init__(self, encode_many: Callable[[list[str]], list[bytes]], end: bytes = b"", limit: int = CACHED_CHUNKS):
        super().__init__(encode_many, limit)
        self.end, (self.before, self.after) = end, piece_tables()

    @staticmethod
    def chunk(word: bytes) -> str:
        return " " + word.lstrip(BLANKS).decode()

    def cut(self, texts: pa.Array) -> pa.DictionaryArray:
        """The pieces of all texts in a row, ``TEXT_END`` after each text."""
        whole = pc.binary_join_element_wise(pc.fill_null(texts, "").cast(pa.binary()), b"", TEXT_END)
        at = np.frombuffer(whole.buffers()[1], np.int32, len(whole) + 1, 4 * whole.offset)
        data = whole.buffers()[2][int(at[0]) : int(at[-1])].to_pybytes()
        if b"\xcc" not in data and b"\xcd" not in data:  # the lead bytes of U+0300 to U+036F
            data = data.lower()
        before, after = (np.frombuffer(data.translate(t), np.uint8) for t in (self.before, self.after))
        ends = np.flatnonzero((before[:-1] & after[1:]) == 0) + 1
        offsets = np.concatenate([[0], ends, [len(data)]]).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()

    def __call__(self, texts: pa.Array) -> pa.Array:
        if not len(texts):
            return pa.array([], pa.binary())
        coded = self.cut(texts)
        pieces, numbers = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        found, last = list(map(self.cache.get, pieces)), pieces.index(TEXT_END)
        found[last] = self.end
        missing = [p for p, f in zip(pieces, found) if f is None]
        if missing:
            new = self._looked_up(missing)
            found = [new[p] if f is None else f for p, f in zip(pieces, found)]
        ids = pa.array(found, pa.large_binary()).take(coded.indices)
        places = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1)
        ends = places[1:][numbers == last]
        if len(ends) != len(texts):
            raise ValueError("a text is not UTF-8")
        offsets = np.append(0, ends).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(offsets), ids.buffers()[2]])


def ids_of(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, "<u4")


def library_encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    """Many chunks by one call of the tokenizers library, ``add_special_tokens=False``; the strings of special tokens
    inside a text are ordinary text, as the vocabulary files' notes have it.

    Chunks are joined with a separator between blanks that the vocabulary always makes one id of its own, and the ids
    are cut at it; a chunk that holds the separator goes alone.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True

    def one(text: str) -> np.ndarray:
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    # byte-level vocabularies keep blanks: then every chunk with a leading space starts with an id that has one
    blank = one(" a")
    keeps_blanks = len(blank) > 0 and (len(blank) > 1 or not np.array_equal(blank, one("a")))
    if keeps_blanks:
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        starts = np.zeros(max(vocabulary.values()) + 1, bool)
        space = tokenizer.id_to_token(int(one(" ")[0]))
        starts[[i for t, i in vocabulary.items() if t.startswith(space)]] = True

        def many(chunks: list[str]) -> list[bytes]:
            simple = [c for c in chunks if c[:1] == " " and " " not in c[1:] and len(c) > 1 and not c[1].isspace() and not c[-1].isspace()]
            if len(simple) < 2:
                return [one(c).tobytes() for c in chunks]
            ids = one("".join(simple))
            cuts = np.flatnonzero(starts[ids])
            if len(cuts) != len(simple):
                return [one(c).tobytes() for c in chunks]
            blob, ends = ids.tobytes(), np.append(cuts[1:], len(ids)) * 4
            done = {c: blob[a:b] for c, a, b in zip(simple, (cuts * 4).tolist(), ends.tolist())}
            return [done[c] if c in done else one(c).tobytes() for c in chunks]

    else:
        mark = "\x01"
        sign = one(mark)
        assert len(sign) == 1, "the separator is no single id"

        def many(chunks: list[str]) -> list[bytes]:
            simple = [c for c in chunks if mark not in c]
            if len(simple) < 2:
                return [one(c).tobytes() for c in chunks]
            ids = one(f" {mark} ".join(simple))
            cuts = np.flatnonzero(ids == sign[0])
            if len(cuts) != len(simple) - 1:
                return [one(c).tobytes() for c in chunks]
            blob, begins, ends = ids.tobytes(), np.append(0, cuts + 1) * 4, np.append(cuts, len(ids)) * 4
            done = {c: blob[a:b] for c, a, b in zip(simple, begins.tolist(), ends.tolist())}
            return [done[c] if c in done else one(c).tobytes() for c in chunks]

    return many


# --- the same vocabularies through a faster merger ------------------------------------------------------------------------

# fixed values: the split patterns of the two kinds of vocabulary
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable Latin-1 for itself, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class CompiledVocabulary:
    """A tokenizers file whose merges are restated as ranks of byte strings, made once on the driver.

    A word-end suffix becomes a trailing blank, whose merges with single bytes come first. Ranks say the same as pairs if
    every merged string, merged by the ranks under its own, ends as exactly the pair of its merge; that is checked here
    for every merge. ``kind`` is ``bytes``, ``words``, or ``library`` where the file is of another make or the check fails.
    """

    def __init__(self, path: str):
        import json

        from kpimill.llm.byte_bpe import Merges

        self.path, self.kind = path, "library"
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, split = file["model"], file.get("pre_tokenizer") or {}
        suffix = model.get("end_of_word_suffix") or ""
        if model.get("type") != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("ignore_merges"):
            return
        if split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space") and not suffix and not file.get("normalizer"):
            kind = "bytes"
        elif (
            suffix
            and [s.get("type") for s in split.get("pretokenizers", [])] == ["Split", "ByteLevel"]
            and split["pretokenizers"][0]["pattern"] == {"Regex": WORD_PATTERN}
            and split["pretokenizers"][0]["behavior"] == "Removed"
            and split["pretokenizers"][0]["invert"]
            and not split["pretokenizers"][1]["use_regex"]
            and [s.get("type") for s in (file.get("normalizer") or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        ):
            kind = "words"
        else:
            return
        alphabet, vocabulary = byte_alphabet(), model["vocab"]

        def raw(token: str) -> bytes:
            end = b""
            if suffix and token.endswith(suffix) and token != suffix:
                token, end = token[: -len(suffix)], b" "
            return bytes(alphabet[c] for c in token) + end

        id_of = {}
        for token, i in vocabulary.items():
            if all(c in alphabet for c in (token[: -len(suffix)] if suffix and token.endswith(suffix) else token)):
                id_of[raw(token)] = i
        ranks = {bytes([b]): b for b in range(256)}
        if suffix:
            ranks |= {bytes([b, 32]): 256 + b for b in range(256)}
        pairs = []
        for merge in model["merges"]:
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            a, b = raw(a), raw(b)
            if a + b in ranks:
                return
            ranks[a + b] = len(ranks)
            pairs.append((a, b))
        check = Merges(ranks)
        if any(check.merged(a + b, ranks[a + b]) != [a, b] for a, b in pairs):
            return
        self.ranks = ranks
        self.ids = np.zeros(len(ranks), "<u4")
        for token, rank in ranks.items():
            self.ids[rank] = id_of.get(token, 0)
        self.kind = kind

    def encoder(self) -> Callable[[list[str]], list[bytes]]:
        """Many chunks to the ids that the tokenizers library gives them."""
        if self.kind == "library":
            return library_encoder(self.path)
        import unicodedata

        import regex
        import tiktoken

        words = self.kind == "words"
        merger = tiktoken.Encoding("compiled", pat_str=r"[^ ]+ " if words else BYTE_LEVEL_PATTERN, mergeable_ranks=self.ranks, special_tokens={})
        ids_by_rank, find, spare = self.ids, regex.compile(WORD_PATTERN).findall, None

        def cut(ids: np.ndarray, begins: list[int], ends: list[int]) -> list[bytes]:
            blob = ids.tobytes()
            return [blob[a:b] for a, b in zip(begins, ends)]

        if not words:

            def many(chunks: list[str]) -> list[bytes]:
                if len(chunks) == 1:
                    return [ids_by_rank[merger.encode_ordinary(chunks[0])].tobytes()]
                found = list(map(merger.encode_ordinary, chunks))
                ends = list(accumulate(4 * n for n in map(len, found)))
                return cut(ids_by_rank[list(chain.from_iterable(found))], [0, *ends], ends)

            return many

        # a piece is a word and its end, and only the token that ends it holds a blank
        ends_piece = np.zeros(len(self.ranks), bool)
        ends_piece[[rank for token, rank in self.ranks.items() if token.endswith(b" ")]] = True

        def known_script(text: str) -> bool:
            # lower-casing and classes of these scripts are the same in every library; the rest goes to the library itself
            return text.isascii() or max(text) < "Ͱ"

        def pieces(chunk: str) -> list[str]:
            text = unicodedata.normalize("NFC", chunk).lower()
            word = text[1:]
            return [word] if text[:1] == " " and word.isalpha() else find(text)

        def many(chunks: list[str]) -> list[bytes]:
            nonlocal spare
            simple = chunks if known_script("".join(chunks)) else [c for c in chunks if known_script(c)]
            made: list[bytes] = []
            split = list(map(pieces, simple))
            words = list(chain.from_iterable(split))
            ranks = np.array(merger.encode_ordinary(" ".join(words) + " ") if words else [], np.int64)
            ends = np.append(0, np.flatnonzero(ends_piece[ranks]) + 1)
            if len(ends) == len(words) + 1:
                at = (4 * ends[[0, *accumulate(map(len, split))]]).tolist()
                made = cut(ids_by_rank[ranks], at, at[1:])
            if len(made) == len(chunks):
                return made
            done = dict(zip(simple, made))
            left = [c for c in chunks if c not in done]
            if left:
                spare = spare or library_encoder(self.path)
                done |= dict(zip(left, spare(left)))
            return list(map(done.__getitem__, chunks))

        return many

    def batch_encoder(self, end: bytes) -> Callable[[pa.Array], pa.Array]:
        """Many texts (null: empty) to their ids with ``end`` after each, as a binary array."""
        if self.kind == "words":
            return PieceEncoder(self.encoder(), end)
        run = ChunkEncoder(self.encoder())
        return lambda texts: pa.array([run(t or "") + end for t in texts.to_pylist()], pa.binary())
