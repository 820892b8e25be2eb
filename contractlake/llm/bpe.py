"""Byte-level BPE, encoded and decoded by rounds of merges over flat arrays.

A text is cut into words by the classes of its characters. The words of a block that were not met
before lie behind each other in one array of symbols; a round looks up all neighbouring pairs by
binary search in the sorted pair keys and merges, in every word, the pair of lowest rank wherever
it occurs. Words that have no pair left leave the array, so a round costs what is still open.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from contractlake.llm.common import map_batches, per_process

# Characters worked on at once, and the words and ids that are remembered between blocks.
BLOCK = 1 << 20
MAX_WORDS, MAX_IDS = 1 << 20, 1 << 23
# Words with more symbols than this are merged by themselves.
LONG = 256
# Letters, numbers, blanks, all else.
OTHER, LETTER, NUMBER, BLANK = range(4)
# A place where a word ends whatever follows: a visible character, then a blank.
BREAK = re.compile(r"[!-~](?= )")
NO_PAIR = np.iinfo(np.int32).max


@dataclass(frozen=True)
class Vocabulary:
    """Tables of one vocabulary file."""

    symbols: np.ndarray  # id of each byte
    keys: np.ndarray  # left * size + right of each merge, sorted
    ranks: np.ndarray  # place of that merge among the merges
    merged: np.ndarray  # id it gives
    size: int
    classes: np.ndarray  # of each code point
    added: dict[str, int]  # tokens matched in a text before it is cut into words
    split: re.Pattern | None
    pieces: dict[int, bytes]  # bytes of each id


def _byte_letters() -> dict[str, int]:
    # Fixed rule of byte-level vocabularies: printable bytes stand for themselves, the others for
    # characters from 256 on, in order.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def read_vocabulary(path: str) -> Vocabulary:
    """The tables of a vocabulary file with byte-level words; read once per process.

    Files that ask for anything else (a normalizer, dropout, other words, added tokens that take
    blanks along) are refused, and so is one in which a merge comes before those that make its
    parts: there merging a pair everywhere at once could differ from merging it place by place.
    """
    return per_process(("vocabulary", path), lambda: _read(path))


def _read(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model, words = content["model"], content["pre_tokenizer"] or {}
    asked = [model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")]
    plain = words.get("type") == "ByteLevel" and words.get("use_regex", True) and not words.get("add_prefix_space")
    if content.get("normalizer") or any(asked) or not plain or (content.get("decoder") or {}).get("type") != "ByteLevel":
        raise ValueError(f"{path}: only plain byte-level vocabularies can be read")
    added = content.get("added_tokens") or []
    for token in added:
        if any(token.get(flag) for flag in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"added token {token['content']!r} is not matched as it stands")
    ids = model["vocab"]
    letters = _byte_letters()
    # Places of merges; a byte is there from the start.
    made = {ids[letter]: -1 for letter in letters}
    pairs = [merge.split(" ") if isinstance(merge, str) else merge for merge in model["merges"]]
    table = np.zeros((len(pairs), 3), np.int64)
    for rank, (left, right) in enumerate(pairs):
        table[rank] = ids[left], ids[right], ids[left + right]
        if not max(made.get(ids[left], rank), made.get(ids[right], rank)) < rank:
            raise ValueError(f"{path}: merge {rank} comes before the merges that make its parts")
        made.setdefault(ids[left + right], rank)
    size = max([*ids.values(), *(token["id"] for token in added)], default=0) + 1
    keys = table[:, 0] * size + table[:, 1]
    order = np.argsort(keys, kind="stable")
    strings = {token["content"]: token["id"] for token in added}
    longest = sorted(strings, key=len, reverse=True)
    tokens = {i: token for token, i in ids.items()} | {i: token for token, i in strings.items()}
    return Vocabulary(
        np.array([ids[letter] for letter, _ in sorted(letters.items(), key=lambda x: x[1])], np.int64),
        keys[order], order.astype(np.int32), table[order, 2], size, character_classes(path),
        strings, re.compile("|".join(map(re.escape, longest))) if longest else None,
        {i: _token_bytes(token, letters) for i, token in tokens.items()},
    )


def _token_bytes(token: str, letters: dict[str, int]) -> bytes:
    found = [letters.get(c) for c in token]
    return token.encode() if None in found else bytes(found)


def character_classes(path: str) -> np.ndarray:
    """The class of every code point, as the library that reads the file sees it.

    Which characters are letters or numbers depends on the version of its character tables, so it
    is asked: cut all characters in order into words, then one character of each word.
    """
    from tokenizers import Tokenizer

    cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    points = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)])
    points = points[points != 0x20]  # a blank joins the word after it
    classes = np.full(0x110000, OTHER, np.uint8)
    classes[0x20] = BLANK
    for first in range(0, len(points), 1 << 16):
        part = points[first : first + (1 << 16)]
        text = part.astype("<u4").tobytes().decode("utf-32-le")
        for _, (start, stop) in cut(text):
            c = text[start]
            for kind, before in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!"), (BLANK, "\t")):
                if kind == BLANK or len(cut(before + c)) == 1:
                    classes[part[start:stop]] = kind
                    break
    return classes


def word_starts(points: np.ndarray, firsts: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Places where words begin in code points of several texts, which begin at ``firsts``.

    A word is a run of one class, with one blank character U+0020 in front of it if there is one;
    of the blanks before a word the last one alone is split off; and an apostrophe that begins a
    word takes the ending of a contraction with it and nothing more.
    """
    n = len(points)
    kinds = classes[points]
    begins = np.zeros(n + 1, bool)
    begins[1:n] = kinds[1:] != kinds[:-1]
    begins[firsts] = True
    edge = begins.copy()
    edge[n] = True
    text_edge = np.zeros(n + 1, bool)
    text_edge[firsts] = True
    text_edge[n] = True
    # The last blank of a run that a word of the same text follows.
    last = np.flatnonzero((kinds == BLANK) & edge[1:] & ~text_edge[1:])
    begins[last] = True
    begins[last[points[last] == 0x20] + 1] = False
    marks = np.flatnonzero((points == 0x27) & edge[:n] & edge[1:] & begins[:n])
    # Endings of contractions.
    for ending in ("s", "t", "re", "ve", "m", "ll", "d"):
        size = len(ending)
        found = marks[marks + size < n]
        for i, c in enumerate(ending):
            found = found[(points[found + 1 + i] == ord(c)) & ~text_edge[found + 1 + i]]
        begins[found + 1] = False
        begins[found + 1 + size] |= ~edge[found + 1 + size]
    return np.flatnonzero(begins[:n])


def _ranks(symbols: np.ndarray, places: np.ndarray, last: np.ndarray, words: Vocabulary) -> np.ndarray:
    """Rank of the pair that begins at each place; ``last`` marks the last symbols of words."""
    ranks = np.full(len(places), NO_PAIR, np.int32)
    inner = np.flatnonzero(~last[places])
    at = places[inner]
    key = symbols[at] * words.size + symbols[at + 1]
    found = np.minimum(np.searchsorted(words.keys, key), len(words.keys) - 1)
    hit = words.keys[found] == key if len(words.keys) else np.zeros(len(key), bool)
    ranks[inner[hit]] = words.ranks[found[hit]]
    return ranks


def merge_rounds(
    symbols: np.ndarray, lengths: np.ndarray, vocabulary: Vocabulary
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words given as symbols behind each other, and how many each word has.

    Every round takes the lowest rank of each word and merges that pair wherever it occurs in it,
    from the left where occurrences overlap. Only pairs beside a merge are looked up again.
    """
    merged_of = np.zeros(len(vocabulary.ranks), np.int64)
    merged_of[vocabulary.ranks] = vocabulary.merged
    words = np.arange(len(lengths))
    final = lengths.copy()
    done: list[tuple[np.ndarray, np.ndarray]] = []
    stops = np.cumsum(lengths)
    last = np.zeros(len(symbols), bool)
    last[stops - 1] = True
    ranks = _ranks(symbols, np.arange(len(symbols)), last, vocabulary)
    while len(words):
        starts = np.cumsum(lengths) - lengths
        lowest = np.minimum.reduceat(ranks, starts)
        open_words = lowest != NO_PAIR
        if not open_words.all():
            stays = np.repeat(open_words, lengths)
            done.append((np.repeat(words[~open_words], lengths[~open_words]), symbols[~stays]))
            final[words[~open_words]] = lengths[~open_words]
            symbols, last, ranks = symbols[stays], last[stays], ranks[stays]
            words, lengths, lowest = words[open_words], lengths[open_words], lowest[open_words]
            if not len(words):
                break
        taken = ranks == np.repeat(lowest, lengths)
        places = np.flatnonzero(taken)
        # Overlapping places follow each other: every second one of such a run is taken.
        order = np.arange(len(places))
        fresh = np.ones(len(places), bool)
        fresh[1:] = np.diff(places) != 1
        run = np.maximum.accumulate(np.where(fresh, order, 0))
        places = places[(order - run) % 2 == 0]
        symbols[places] = merged_of[ranks[places]]
        last[places] = last[places + 1]
        stays = np.ones(len(symbols), bool)
        stays[places + 1] = False
        gone = np.cumsum(~stays)
        owner = np.repeat(np.arange(len(words)), lengths)[places]
        lengths = lengths - np.bincount(owner, minlength=len(words))
        symbols, last, ranks = symbols[stays], last[stays], ranks[stays]
        at = places - gone[places]
        near = np.union1d(at, at[at > 0] - 1)
        ranks[near] = _ranks(symbols, near, last, vocabulary)
    if not done:
        return np.zeros(0, np.int64), final
    word = np.concatenate([w for w, _ in done])
    ids = np.concatenate([s for _, s in done])
    return ids[np.argsort(word, kind="stable")], final


class Encoder:
    """Ids of texts; remembers the words it has met, up to a bound."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.starts, self.lengths, self.ids = (np.zeros(0, np.int64) for _ in range(3))

    def _learn(self, fresh: list[str]) -> None:
        """Merge new words: the short ones all at once, each long one by itself."""
        long = [word for word in fresh if len(word) > LONG]
        short = [word for word in fresh if len(word) <= LONG]
        for group in ([short] if short else []) + [[word] for word in long]:
            encoded = [word.encode() for word in group]
            sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
            symbols = self.vocabulary.symbols[np.frombuffer(b"".join(encoded), np.uint8)]
            ids, counts = merge_rounds(symbols, sizes, self.vocabulary)
            self.known.update(zip(group, range(len(self.known), len(self.known) + len(group))))
            self.starts = np.append(self.starts, len(self.ids) + np.cumsum(counts) - counts)
            self.lengths = np.append(self.lengths, counts)
            self.ids = np.append(self.ids, ids)

    def block(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Ids of each text; none of them is empty."""
        joined = "".join(texts)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        firsts = np.cumsum(sizes) - sizes
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        starts = word_starts(points, firsts, self.vocabulary.classes)
        places = [*starts.tolist(), len(joined)]
        words = [joined[a:b] for a, b in zip(places, places[1:])]
        if len(self.known) > MAX_WORDS or len(self.ids) > MAX_IDS:
            self._forget()
        fresh = set(words).difference(self.known)
        if fresh:
            self._learn(list(fresh))
        index = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        counts = self.lengths[index]
        before = np.cumsum(counts) - counts
        flat = self.ids[np.repeat(self.starts[index] - before, counts) + np.arange(counts.sum())]
        cuts = np.append(before, len(flat))[np.searchsorted(starts, firsts)]
        return np.split(flat, cuts[1:])

    def encode(self, texts: Sequence[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text in order, null as empty."""
        begun: list[list[np.ndarray | None]] = []
        slots: list[tuple[list[np.ndarray | None], int]] = []
        waiting: list[str] = []
        size = 0

        def fill() -> None:
            for (parts, i), ids in zip(slots, self.block(waiting) if waiting else []):
                parts[i] = ids
            slots.clear()
            waiting.clear()

        for text in texts:
            parts: list[np.ndarray | None] = []
            begun.append(parts)
            for piece, token in self._parts(text or ""):
                if token is not None:
                    parts.append(np.array([token], np.int64))
                    continue
                slots.append((parts, len(parts)))
                parts.append(None)
                waiting.append(piece)
                size += len(piece)
                if size >= BLOCK:
                    fill()
                    size = 0
            if not waiting:
                yield from map(_joined, begun)
                begun.clear()
        fill()
        yield from map(_joined, begun)

    def _parts(self, text: str) -> Iterator[tuple[str, int | None]]:
        """Pieces of a text that are encoded by themselves, and added tokens (with an empty piece)."""
        split = self.vocabulary.split
        place = 0
        for match in split.finditer(text) if split else ():
            for piece in _pieces(text[place : match.start()]):
                yield piece, None
            yield "", self.vocabulary.added[match[0]]
            place = match.end()
        for piece in _pieces(text[place:] if place else text):
            yield piece, None


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _pieces(text: str) -> Iterator[str]:
    """A text in pieces of about a block, cut where a word ends in any case."""
    place = 0
    while len(text) - place > BLOCK:
        found = BREAK.search(text, place + BLOCK)
        if not found:
            break
        yield text[place : found.end()]
        place = found.end()
    if place < len(text):
        yield text[place:]


def decode(ids: np.ndarray, vocabulary: Vocabulary) -> str:
    """The text of ids, added tokens as their strings; ids of no token give nothing, and bytes that
    are no UTF-8 the replacement character."""
    found = map(vocabulary.pieces.get, ids.tolist())
    return b"".join([piece for piece in found if piece is not None]).decode("utf-8", "replace")


def _with_row(df: DataFrame, name: str) -> DataFrame:
    """The named column, and all others as the struct ``row`` (null where there are none)."""
    others = [F.col(f"`{n}`") for n in df.columns if n != name]
    row = F.struct(*others) if others else F.lit(None).cast("int")
    return df.select(row.alias("row"), F.col(f"`{name}`").alias(name))


def encode_texts(documents: DataFrame, path: str) -> DataFrame:
    """``row``, a struct of all columns but ``text``, and ``ids`` of the whole text as the file at
    ``path`` encodes it: unsigned 32-bit numbers, least byte first, as one binary value.

    Strings of added tokens in a text give these tokens. Null and empty texts have no ids; rows
    with null keys and equal rows stay rows; an empty table gives an empty one; a text of any
    length is encoded, in blocks; further columns may have any name.
    """
    named = _with_row(documents, "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        encoder = Encoder(read_vocabulary(path))
        for batch in batches:
            found = [x.astype("<u4").tobytes() for x in encoder.encode(batch.column("text").to_pylist())]
            yield {"row": batch.column("row"), "ids": pa.array(found, pa.binary())}

    return map_batches(named, work, T.StructType([named.schema["row"], T.StructField("ids", T.BinaryType())]))


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """``row``, a struct of all columns but ``ids``, and the ``text`` that the ids stand for.

    Null ids give an empty text; see :func:`decode` for ids of no token and for bytes that are no
    text, and :func:`encode_texts` for awkward rows.
    """
    named = _with_row(encoded, "ids")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        vocabulary = read_vocabulary(path)
        for batch in batches:
            found = [decode(np.frombuffer(x or b"", "<u4"), vocabulary) for x in batch.column("ids").to_pylist()]
            yield {"row": batch.column("row"), "text": pa.array(found, pa.string())}

    return map_batches(named, work, T.StructType([named.schema["row"], T.StructField("text", T.StringType())]))


def token_count(ids: Column) -> Column:
    """Number of ids of an encoded text."""
    return F.coalesce((F.octet_length(ids) / 4).cast("long"), F.lit(0).cast("long"))
