"""Token ids by the tokenizers library, with the ids of words seen before kept in each Python worker."""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterator
from functools import cache
from itertools import groupby, pairwise
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Both byte-level and word-end BPE cut a text before merging, and never join a character before a lone space with one
# after it; such a text can be cut there and its pieces encoded one by one.
SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
RUN_OF_SPACE, ODD_SPACE = re.compile(r"\s\s"), re.compile("[\x1c-\x1f]")
KEPT_PIECES, LONGEST_KEPT = 400_000, 64
# Between pieces that are encoded in one call; each kind of tokenizer makes one id of it that nothing else gives.
LED_BREAK, WORD_BREAK = "\n", " \x01 "
MARKS = ",."
FIRST = "\n\n"
END_ID = 2


PACK = [struct.Struct(f"<{n}I").pack for n in range(4 * LONGEST_KEPT + 1)]
PROBES = ("the", "Zürich", "GARÇON", "straße", "ñandú", "éèêëÿ", "qzx" * 9)


def _letters_of_bytes() -> dict[int, str]:
    """Byte-level tokenizers write a byte as a character that can be seen: itself if it can, else the next from 256 on."""
    seen = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) if b in seen else chr(256 + hidden.index(b)) for b in range(256)}


BYTE_LETTERS = _letters_of_bytes()
SPELLING = np.array([ord(BYTE_LETTERS[b]) for b in range(256)], "<u2")


def _spelled(text: str) -> str:
    return text if text.isascii() else text.encode().decode("latin-1").translate(BYTE_LETTERS)


def _spell_led(text: str) -> str | None:
    """A word, with or without a space before it, as a byte-level tokenizer's model sees it; None for other texts."""
    word = text[1:] if text[:1] == " " else text
    if not word.isalpha() or len(word) > LONGEST_KEPT:
        return None
    return _spelled(word) if word is text else BYTE_LETTERS[0x20] + _spelled(word)


def _spell_word(text: str) -> str | None:
    """A word in lower case as a word-end tokenizer's model sees it; None for other texts, and for letters beyond Latin-1,
    of which lower case and composition have rules of their own."""
    if not text.isalpha() or len(text) > LONGEST_KEPT or max(text) > "\xff":
        return None
    return _spelled(text.lower())


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit numbers, the same as of one `encode` call on each text.

    A special token's string in a text gives that token's id, as the tokenizer has it; none are added. Texts with such a string are
    encoded whole. Ids are kept for the latest pieces, bounded in number and length.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        added = self._tokenizer.get_added_tokens_decoder().values()
        self._special = re.compile("|".join(re.escape(token.content) for token in added)) if added else None
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        kinds = json.dumps([model.get("normalizer"), model.get("pre_tokenizer")])
        byte_level = (model.get("pre_tokenizer") or {}).get("type") == "ByteLevel" and model.get("normalizer") is None
        word_level = "Lowercase" in kinds and "Prepend" not in kinds and "Metaspace" not in kinds
        prefixed = '"add_prefix_space": true' in kinds
        # A special token that is looked for after normalising could stand in any text.
        plain = not any(token.normalized for token in added)
        self._cuts, self._led = (byte_level or word_level) and not prefixed and plain, byte_level
        self._break = LED_BREAK if byte_level else WORD_BREAK
        found = self._tokenizer.encode(self._break, add_special_tokens=False).ids
        self._break_id = found[0] if len(found) == 1 else None
        self._marks = punctuation if byte_level else MARKS
        # Words of common letters go to the tokenizer's model at once, spelled as its steps before the model would.
        self._model = self._tokenizer.model
        self._spell = _spell_led if byte_level else _spell_word if word_level else None
        for probe in PROBES:
            for text in (probe, " " + probe) if byte_level else (probe,):
                if self._spell and (spelled := self._spell(text)):
                    expected = self._tokenizer.encode(text, add_special_tokens=False).ids
                    if [token.id for token in self._model.tokenize(spelled)] != expected:
                        self._spell = None
        self._ids: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for at in range(0, len(texts), 1024):
            encoded = self._tokenizer.encode_batch_fast(texts[at : at + 1024], add_special_tokens=False)
            out += [np.array(e.ids, "<u4").tobytes() for e in encoded]
        return out

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """As `_encode`, for pieces without white space but one leading space: many in one call, cut at the break."""
        out: list[bytes] = []
        for at in range(0, len(words), 4096):
            some = words[at : at + 4096]
            encoded = self._tokenizer.encode_batch_fast([self._break.join(some)], add_special_tokens=False)[0]
            ids = np.array(encoded.ids, "<u4")
            ends = [*np.flatnonzero(ids == self._break_id).tolist(), len(ids)]
            if len(ends) != len(some):
                out += self._encode(some)
                continue
            data, start = ids.tobytes(), 0
            for end in ends:
                out.append(data[4 * start : 4 * end])
                start = end + 1
        return out

    def _cut(self, text: str) -> list[str]:
        """The text's pieces, by the names under which their ids are kept."""
        if not self._led:
            # White space only ever separates. Python's split() knows four characters more than the tokenizer.
            return SAFE_CUT.split(text) if ODD_SPACE.search(text) else text.split()
        first, *rest = SAFE_CUT.split(text)
        return [FIRST + first, *rest]

    def _pieces(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The names of all texts' pieces one after another, and where each text's end."""
        # With byte-level BPE a space belongs to the word after it, so a name stands for a space and a word; a lone line end
        # stands for itself, and a name that begins with one for it and a word. The first word has nothing before it.
        runs = []
        for lone, run in groupby(texts, self._lone_spaces):
            if lone:
                led = pa.array([FIRST + t.replace("\n", " \n") for t in run], pa.large_string())
                runs.append(pc.split_pattern(led, " "))
            else:
                runs.append(pa.array([self._cut(t) for t in run], pa.list_(pa.large_string())))
        names = pa.concat_arrays([r.flatten() for r in runs])
        return names, np.cumsum(np.concatenate([pc.list_value_length(r).to_numpy() for r in runs]), dtype=np.int64)

    def _lone_spaces(self, text: str) -> bool:
        return self._led and not (text[:1].isspace() or text[-1:].isspace() or RUN_OF_SPACE.search(text))

    def _marked(self, names: set[str]) -> dict[str, tuple[str, str]]:
        """Of the names that are words with marks after them, those of the word and of the marks, whose ids they have. In lower
        case the word must be all letters too; between words, marks are only known to be apart one by one."""
        marks, led, found = self._marks, self._led, {}
        for n in names:
            if n[-1:] in marks:
                stem = n.rstrip(marks) if led else n[:-1]
                if stem.lstrip("\n").lower().isalpha():
                    found[n] = stem, FIRST + n[len(stem) :] if led else n[-1]
        return found

    def _new_ids(self, names: list[str]) -> dict[str, bytes]:
        """The ids of pieces that are not kept."""
        found, others = self._words(names) if self._spell else ({}, names)
        found.update(self._other_ids(others))
        return found

    def _words(self, names: list[str]) -> tuple[dict[str, bytes], list[str]]:
        """The ids of the names that are words and spelled all together, and the other names."""
        words, others = [], []
        for n in names:
            word = n.isalpha() and len(n) <= LONGEST_KEPT and (self._led or n.isascii() or max(n) <= "\xff")
            (words if word else others).append(n)
        if not words:
            return {}, others
        joined = "\n " + "\n ".join(words) if self._led else "\n" + "\n".join(words).lower()
        spelled = SPELLING[np.frombuffer(joined.encode(), "u1")].tobytes().decode("utf-16-le").split(BYTE_LETTERS[0x0A])
        tokenize, pack, found = self._model.tokenize, PACK, {}
        for n, letters in zip(words, spelled[1:], strict=True):
            ids = [token.id for token in tokenize(letters)]
            found[n] = pack[len(ids)](*ids)
        return found, others

    def _other_ids(self, names: list[str]) -> dict[str, bytes]:
        texts, after_line = {n: n for n in names}, set()
        if self._led:
            for n in names:
                if n.startswith(FIRST):
                    texts[n] = n[len(FIRST) :]
                elif n.startswith("\n"):
                    texts[n] = n[1:]
                    after_line.add(n)
                else:
                    texts[n] = " " + n
        found, words, others = {}, [], []
        for n, text in texts.items():
            if self._spell and (spelled := self._spell(text)):
                ids = [token.id for token in self._model.tokenize(spelled)]
                found[n] = PACK[len(ids)](*ids)
            elif self._break_id is not None and len(text) > 1 and text[1:].isprintable() and " " not in text[1:]:
                words.append(n)
            else:
                others.append(n)
        found.update(zip(words, self._encode_words([texts[n] for n in words]), strict=True))
        found.update(zip(others, self._encode([texts[n] for n in others]), strict=True))
        if after_line:
            line_end = self._encode(["\n"])[0]
            found.update((n, line_end + found[n]) for n in after_line)
        return found

    def batch(self, texts: list[str]) -> list[bytes]:
        if not self._cuts:
            return self._encode(texts)
        whole = [i for i, t in enumerate(texts) if self._special and self._special.search(t)]
        if whole:
            of_whole = dict(zip(whole, self._encode([texts[i] for i in whole]), strict=True))
            others = iter(self.batch([t for i, t in enumerate(texts) if i not in of_whole]))
            return [of_whole[i] if i in of_whole else next(others) for i in range(len(texts))]
        if not texts:
            return []
        pieces, ends = self._pieces(texts)
        pieces = pieces.dictionary_encode()
        names = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self._ids) > KEPT_PIECES:
            self._ids, self._older = {}, self._ids
        known, older = self._ids, self._older
        new = {n for n in names if n not in known}
        marked = self._marked(new)
        new.difference_update(marked)
        new.update(n for parts in marked.values() for n in parts if n not in known)
        seen = new & older.keys()
        known.update((n, older[n]) for n in seen)
        new -= seen
        known.update(self._new_ids(list(new)))
        made = {n: known[stem] + known[marks] for n, (stem, marks) in marked.items()}
        # Names are looked up once each; their ids are put in the places of the pieces all together.
        placed = pa.array([made[n] if n in made else known[n] for n in names], pa.large_binary()).take(pieces.indices)
        at = np.concatenate([[0], np.cumsum(pc.binary_length(placed).to_numpy())])[[0, *ends]].tolist()
        data = memoryview(placed.buffers()[2] or b"")
        out = [bytes(data[start:end]) for start, end in pairwise(at)]
        # Kept are words; what seldom comes again makes room.
        for n in [n for n in new if len(n) > LONGEST_KEPT or n[:1] == "\n"]:
            del known[n]
        return out

    def rest(self) -> None:
        """Give back half of what is kept; after a task, as the worker may wait for long."""
        self._older = {}


@cache
def encoder(path: str) -> Encoder:
    """One encoder a Python worker and path."""
    return Encoder(path)


def slices(part: pa.RecordBatch, text: int, most_bytes: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with texts of about `most_bytes`, or one longer, so that few texts are Python strings at a time."""
    lengths = pc.fill_null(pc.binary_length(part.column(text)), 0).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.diff(np.cumsum(lengths, dtype=np.int64) // most_bytes)) + 1
    for start, end in pairwise([0, *cuts.tolist(), part.num_rows]):
        yield part.slice(start, end - start)


def batches(texts: list[str | None], most_chars: int = 1 << 22) -> list[list[str]]:
    """The texts in order, null as empty, in lists of about `most_chars`, so that memory follows the longest text."""
    out: list[list[str]] = [[]]
    held = 0
    for text in texts:
        if held > most_chars:
            out.append([])
            held = 0
        out[-1].append(text or "")
        held += len(text or "")
    return out
