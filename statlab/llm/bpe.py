"""BPE encoding and decoding with content-defined chunk reuse.

A text is cut where a rolling hash of its last bytes says so, so passages that documents share fall into the same
chunks. Chunks that several documents hold are encoded once. A cut may part a word: a chunk's tokens are kept for its
inner words, and at each join the word that lies across it is encoded again from both sides' ends. Words are parted by
a space or line break, which the tokenizer drops, so after that repair the tokens agree with those of the whole text.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlab.llm.common import byte_sums, handing_back, mix64, slices, text_bytes
from statlab.session import stage

#: A cut at one byte in 2**10 on average; the rolling hash covers 16 bytes.
CUT_BITS, WINDOW = 10, 16
#: Words a task remembers at most, texts it encodes at a time, and their bytes, unless one text has more.
REMEMBERED, TEXTS, TEXT_BYTES = 700_000, 256, 1 << 20
#: Bytes whose words are looked up at a time, unless one word has more; longer words have their digest for a name.
BLOCK, LONG = 1 << 18, 255
#: Signs that may part words which are encoded as one text: the first that is one token by itself.
MARKS = "§¶¤¬¦÷×±°|~^"
_GAP = re.compile(b"[ \n]")
#: A pre-tokenizer's pattern none of whose matches goes on from a letter, digit or other sign of ASCII to one of another
#: kind, but for those that begin with an apostrophe.
KINDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The kinds of bytes: a gap between words, letters, digits, signs; the others (no ASCII, control codes) end no part.
_GAPS, _LETTERS, _DIGITS, _SIGNS, _OTHERS = range(5)
_KIND = np.full(256, _OTHERS, dtype=np.uint8)
_KIND[33:127] = _SIGNS
_KIND[48:58] = _DIGITS
_KIND[65:91] = _KIND[97:123] = _LETTERS
_KIND[[10, 32]] = _GAPS
#: Words, parted by spaces, whose characters no normalization makes more or fewer bytes.
_PLAIN = re.compile("[ -~¡-ÿ]+")
_GEAR = (mix64(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def cuts(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The ends of each text's chunks, in bytes of ``data``; an empty text has none.

    The hash is a sum over the last 16 bytes, the bytes before counted twice as much as the next: it is built by
    doubling, four passes over the bytes of all texts. Only whole code points are parted.
    """
    rolling = _GEAR[data]
    step = 1
    while step < WINDOW:
        wider = rolling.copy()
        wider[step:] += rolling[:-step] << np.uint32(step)
        rolling, step = wider, step * 2
    head = np.concatenate([(data[1:] & 0xC0) != 0x80, [True]]) if len(data) else np.zeros(0, dtype=bool)
    ends = np.flatnonzero((rolling >> np.uint32(WINDOW - CUT_BITS) & np.uint32((1 << CUT_BITS) - 1) == 0) & head) + 1
    found = []
    for a, b in zip(offsets[:-1], offsets[1:]):
        inner = ends[np.searchsorted(ends, a + WINDOW):np.searchsorted(ends, b)]
        found.append(np.append(inner, b) if b > a else inner[:0])
    return found


def _digest(chunk: bytes) -> bytes:
    return xxhash.xxh3_128_digest(chunk)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per chunk: the text's name, its place and its digest."""
    for batch in slices(batches):
        data, offsets = text_bytes(batch.column("text"))
        raw, names, places, digests = data.tobytes(), [], [], []
        for name, start, ends in zip(batch.column("tid").to_pylist(), offsets, cuts(data, offsets)):
            for place, end in enumerate(ends):
                names.append(name)
                places.append(place)
                digests.append(_digest(raw[start:end]))
                start = end
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int64()), pa.array(places, pa.int32()), pa.array(digests, pa.binary())], ["tid", "place", "digest"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        press = zstandard.ZstdCompressor(level=3)
        texts = [press.compress((t or "").encode()) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("tid"), pa.array(texts, pa.binary())], ["tid", "packed"])


class Words:
    """The tokens of words, each encoded by the tokenizer when it is first met; a task remembers a bounded number."""

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        single = ((m, self.tokenizer.encode(m, add_special_tokens=False).ids) for m in MARKS)
        self.mark, self.mark_id = next(((m, ids[0]) for m, ids in single if len(ids) == 1), (None, -1))
        self.bytes = self._token_bytes()
        self.added = [t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.parted, self.folded = _parting(json.loads(tokenizer))
        self._forget()

    def _token_bytes(self) -> np.ndarray:
        """The bytes of text each token stands for, where a sign of a token is a byte; without the mark of a word's end."""
        end = getattr(self.tokenizer.model, "end_of_word_suffix", None) or ""
        added = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        found = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=np.int64)
        for token, number in vocabulary.items():
            found[number] = len(token.encode()) if token in added else len(token.removesuffix(end))
        return found

    def _forget(self) -> None:
        self.keys, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.ends, self.flat = np.zeros(1, np.int64), np.zeros(0, np.int32)

    def _of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The words' tokens, end to end, and the number each has; encoded as words, for each of them alone."""
        found = self.tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
        return np.array(found.ids, dtype=np.int32), np.bincount(np.array(found.word_ids, dtype=np.int64), minlength=len(words))

    def _of_marked(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """The same from one text with a mark between the words, which takes less time; nothing if a word's tokens have the mark's."""
        found = self.tokenizer.encode_batch_fast([f" {self.mark} ".join(words)], add_special_tokens=False)[0]
        tokens = np.array(found.ids, dtype=np.int32)
        marks = np.flatnonzero(tokens == self.mark_id)
        if len(marks) != len(words) - 1:
            return None
        return tokens[tokens != self.mark_id], np.diff(np.concatenate([[-1], marks, [len(tokens)]])) - 1

    def _of_joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """The same without marks: words are parted where their tokens' bytes add up to theirs; nothing if they do not."""
        text = " ".join(words)
        tokens = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.int32)
        spaces = np.flatnonzero(np.frombuffer(text.encode(), dtype=np.uint8) == 32)
        wanted = np.append(spaces, len(text.encode())) - np.arange(len(words))
        sizes = self.bytes[tokens]
        read = np.cumsum(sizes)
        if not len(read) or read[-1] != wanted[-1] or not sizes.all():
            return None
        last = np.searchsorted(read, wanted)
        if not np.array_equal(read[last], wanted):
            return None
        return tokens, np.diff(np.concatenate([[-1], last]))

    def _learn(self, words: list[str], keys: np.ndarray) -> None:
        joined = words if _PLAIN.fullmatch(" ".join(words)) else [w for w in words if _PLAIN.fullmatch(w)]
        parted = self._of_joined(joined) if joined else None
        rest = words if parted is None else [] if joined is words else [w for w in words if not _PLAIN.fullmatch(w)]
        plain = [w for w in rest if self.mark not in w] if self.mark else []
        marked = self._of_marked(plain) if plain else None
        odd = rest if marked is None else [w for w in rest if self.mark in w]
        key, places = dict(zip(words, keys.tolist())), {}
        for some, found in ((joined, parted), (plain, marked), (odd, self._of_words(odd) if odd else None)):
            if found is not None:
                tokens, counts = found
                places.update(zip(map(key.__getitem__, some), range(len(self.ends) - 1, len(self.ends) - 1 + len(some))))
                self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts)])
                self.flat = np.concatenate([self.flat, tokens])
        new = np.sort(keys)
        before = np.searchsorted(self.keys, new)
        self.keys = np.insert(self.keys, before, new)
        self.places = np.insert(self.places, before, [places[k] for k in new.tolist()])

    def _parts(self, data: np.ndarray, whole: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes, in small letters if case is nothing to the tokenizer, and where parts of words begin and end in them.

        The last byte is a gap. Words are not parted further if they may be ``whole`` to the tokenizer, and next to
        what is no ASCII, with which a sign may be composed.
        """
        kind = _KIND[data]
        word = kind != _GAPS
        first = np.concatenate([word[:1], word[1:] & ~word[:-1]])
        if self.folded and not whole:
            capital = (data >= 65) & (data <= 90)
            capital[:-1] &= data[1:] < 128
            data = np.where(capital, data + 32, data)
        if self.parted and not whole:
            plain = (kind != _OTHERS) & word
            first[1:] |= plain[1:] & plain[:-1] & (kind[1:] != kind[:-1]) & (data[:-1] != 39)
        return data, np.flatnonzero(first), np.flatnonzero(word[:-1] & (first[1:] | ~word[1:])) + 1

    def _numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The numbers of the parts, which are learned if they are new."""
        raw = data.tobytes()
        if len(data) > 2 * BLOCK:
            named, long = np.zeros(len(starts), dtype=np.uint64), np.arange(len(starts))
        else:
            named, long = byte_sums(data, starts, ends), np.flatnonzero(ends - starts > LONG)
        for i in long.tolist():
            named[i] = xxhash.xxh3_64_intdigest(raw[starts[i]:ends[i]])
        names, one, of = np.unique(named, return_index=True, return_inverse=True)
        places = np.searchsorted(self.keys, names)
        new = places == len(self.keys)
        new[~new] = self.keys[places[~new]] != names[~new]
        if new.any():
            some = one[new]
            self._learn([raw[a:b].decode() for a, b in zip(starts[some].tolist(), ends[some].tolist())], names[new])
            places = np.searchsorted(self.keys, names)
        return self.places[places][of]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The tokens of texts that begin and end at a space or line break."""
        held = [t.encode() for t in texts]
        raw = b"".join([x for t in held for x in (t, b"\n")])
        small = raw.lower()
        whole = any(t in small for t in self.added)
        firsts, sizes, tokens = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        start = 0
        while start < len(raw):
            end = min(start + BLOCK, len(raw))
            end = max(raw.rfind(b" ", start, end), raw.rfind(b"\n", start, end)) + 1 or _GAP.search(raw, end).end()
            if len(self.keys) > REMEMBERED or len(self.flat) > 8 * REMEMBERED:
                self._forget()
            data, begin, close = self._parts(np.frombuffer(raw, np.uint8, end - start, start), whole)
            numbers = self._numbers(data, begin, close)
            at, size = self.ends[numbers], self.ends[numbers + 1] - self.ends[numbers]
            before = np.cumsum(size) - size
            firsts.append(begin + start)
            sizes.append(size)
            tokens.append(self.flat[np.repeat(at - before, size) + np.arange(size.sum())])
            start = end
        before = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        last = np.searchsorted(np.concatenate(firsts), np.cumsum([len(t) + 1 for t in held], dtype=np.int64))
        return np.split(np.concatenate(tokens), before[last][:-1]) if texts else []


def _parting(tokenizer: dict) -> tuple[bool, bool]:
    """Whether words may be parted where the kind of their bytes changes, and whether case is nothing to the tokenizer."""
    def steps(of: str, several: str) -> list[dict]:
        found = tokenizer.get(of) or {}
        return found.get(several, [found])

    before, parts = steps("normalizer", "normalizers"), steps("pre_tokenizer", "pretokenizers")
    blank = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
    known = (all(x in ({}, blank) or x.get("type") in ("NFC", "Lowercase") for x in before)
             and parts[:1] == [{"type": "Split", "pattern": {"Regex": KINDS}, "behavior": "Removed", "invert": True}]
             and all(x.get("type") == "ByteLevel" and not x["use_regex"] and not x["add_prefix_space"] for x in parts[1:])
             and not any(t["normalized"] for t in tokenizer.get("added_tokens") or []))
    return known, known and any(x.get("type") == "Lowercase" for x in before)


def _gap(text: str) -> int:
    """The place of the first space or line break, or the length."""
    places = [p for p in (text.find(" "), text.find("\n")) if p >= 0]
    return min(places, default=len(text))


def inner_part(chunk: str) -> tuple[int, int]:
    """Where a chunk's inner words begin and end: at its first and last space or line break."""
    first = _gap(chunk)
    return first, max(first, chunk.rfind(" "), chunk.rfind("\n"))


def pieces(chunks: list[str], inner: dict[int, np.ndarray]) -> list[str | np.ndarray]:
    """A text as what is to be encoded and what is known, in turn; ``inner`` has tokens by the chunk's place.

    The word across a join is the tail of one chunk and the head of the next, and goes on through a chunk without any
    space: it is encoded as one, with the chunks in between that nobody shares.
    """
    found, open_ = [], ""
    for place, chunk in enumerate(chunks):
        first, last = inner_part(chunk)
        if place in inner and first < len(chunk):
            found += [open_ + chunk[:first], inner[place]]
            open_ = chunk[last:]
        else:
            open_ += chunk
    return [*found, open_]


def encode_pieces(texts: list[list[str | np.ndarray]], words: Words) -> list[np.ndarray]:
    """The tokens of texts in pieces, many texts at a time."""
    fresh = iter(words.encode([p for text in texts for p in text if isinstance(p, str)]))
    return [np.concatenate([next(fresh) if isinstance(p, str) else p for p in text]) for text in texts]


def _text_chunks(text: bytes) -> list[str]:
    data = np.frombuffer(text, dtype=np.uint8)
    ends = cuts(data, np.array([0, len(data)]))[0]
    return [text[a:b].decode() for a, b in zip([0, *ends], ends)]


def _shared_tokens(tokenizer: str):
    """The inner tokens of the chunks asked for, from the text that owns them."""
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, press, open_ = Words(tokenizer), zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        for rows in _opened(batches, open_):
            digests, texts = [], []
            for text, places in rows:
                chunks = _text_chunks(text)
                for place in places:
                    digests.append(_digest(chunks[place].encode()))
                    texts.append(chunks[place][slice(*inner_part(chunks[place]))])
            tokens = [press.compress(t.astype("<i4").tobytes()) for t in words.encode(texts)]
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(tokens, pa.binary())], ["digest", "tokens"])
    return made


def _opened(batches: Iterator[pa.RecordBatch], open_) -> Iterator[list[tuple]]:
    """Rows with their first column's text opened, some texts or about a number of bytes at a time."""
    for whole in batches:
        rows, held = [], 0
        for start in range(0, whole.num_rows, TEXTS):
            for packed, *more in zip(*(c.to_pylist() for c in whole.slice(start, TEXTS).columns)):
                rows.append((open_.decompress(packed), *more))
                held += len(rows[-1][0])
                if held >= TEXT_BYTES or len(rows) == TEXTS:
                    yield rows
                    rows, held = [], 0
        if rows:
            yield rows


def _encoded(tokenizer: str):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, open_ = Words(tokenizer), zstandard.ZstdDecompressor()
        decode = decoder(words.tokenizer)
        for rows in _opened(batches, open_):
            names, texts = [], []
            for text, name, reused in rows:
                names.append(name)
                if reused:
                    inner = {r["place"]: np.frombuffer(open_.decompress(r["tokens"]), dtype="<i4") for r in reused}
                    texts.append(pieces(_text_chunks(text), inner))
                else:
                    texts.append([text.decode()])
            ids = encode_pieces(texts, words)
            ends = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
            ids = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids), pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), ids, decode(ids)], ["tid", "ids", "decoded"])
    return made


def decoder(tokenizer):
    """From lists of tokens to texts. Without a decoder of its own, the tokenizer's text is its tokens parted by spaces."""
    if tokenizer.decoder is not None:
        return lambda ids: pa.array([tokenizer.decode(i, skip_special_tokens=False) for i in ids.to_pylist()], pa.string())
    vocabulary = pa.array([tokenizer.id_to_token(i) for i in range(tokenizer.get_vocab_size(with_added_tokens=True))], pa.string())
    return lambda ids: pc.binary_join(pa.ListArray.from_arrays(ids.offsets, vocabulary.take(ids.values)), " ")


def bpe(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``tid, ids, decoded`` per different text of ``docs``; the text's name is ``tid``, see ``text_name``.

    ``tokenizer`` is the tokenizer file's content. Copies of a text are encoded once, and so is a chunk that several
    texts hold: the text with the smallest name owns it. Texts are dealt out once, compressed, after copies were
    dropped in each task; both the owners and the final pass read them from there. A null text is empty and has no
    tokens.
    """
    texts = docs.select(text_name().alias("tid"), F.coalesce("text", F.lit("")).alias("text"))
    chunks = stage(texts.mapInArrow(handing_back(_chunks), "tid long, place int, digest binary").distinct(), "chunks")
    shared = chunks.groupBy("digest").agg(F.min("tid").alias("owner"), F.max("tid").alias("last"))
    uses = stage(chunks.join(stage(shared.where("owner < last").select("digest", "owner"), "shared"), "digest"), "uses")
    asked = uses.where("tid = owner").groupBy("digest", "tid").agg(F.min("place").alias("place"))
    asked = stage(asked.groupBy("tid").agg(F.collect_list("place").alias("places")), "asked")
    packed = texts.mapInArrow(handing_back(_packed), "tid long not null, packed binary not null").groupBy("tid").agg(F.first("packed").alias("packed"))
    owners = packed.join(asked, "tid").select("packed", "places")
    tokens = owners.mapInArrow(handing_back(_shared_tokens(tokenizer)), "digest binary, tokens binary")
    reused = uses.select("tid", "place", "digest").join(tokens, "digest").groupBy("tid").agg(
        F.collect_list(F.struct("place", "tokens")).alias("reused"))
    known = packed.join(reused, "tid", "left")
    return known.select("packed", "tid", "reused").mapInArrow(
        handing_back(_encoded(tokenizer)), "tid long, ids array<int>, decoded string")


def text_name():
    """A number for equal texts."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """The content of a public tokenizer's file, read where the job is submitted."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def bpe_round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document."""
    made = bpe(docs, tokenizer or tokenizer_file()).select(
        "tid", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
    return docs.select("doc_id", text_name().alias("tid")).join(stage(made, "encoded"), "tid").drop("tid")
