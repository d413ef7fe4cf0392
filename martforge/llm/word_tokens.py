"""Token ids of whole texts by a public tokenizer file (tokenizers library).

The tokenizer drops white space and never joins characters across it, so a
text is cut at ASCII white space and every distinct word is encoded once and
remembered, without the sentence marks behind it, which are pieces of their own;
the ids of a text are the joined ids of its words.  New words are encoded many at a time, joined by a mark that has an id of its own.

Where the tokenizer's file names the rules of ``RULES``, pieces of words of visible
ASCII and Latin letters (U+00C0 to U+017F, composed, with one lower case each) follow
from those rules alone: such words are cut here and only pieces not met before go to
the tokenizer's model, without the normaliser and the cutting that take most of the
library's time.  Words with any other character go through the whole tokenizer."""

from __future__ import annotations

import hashlib
import json
import re
from array import array

import numpy as np

from martforge.llm import common

MARK = "\x01"  # a word of its own between words encoded together
MARKS = b".,;:!?"
LETTERS = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
RUN = 1000  # words encoded together
LATIN = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
PLAIN = re.compile(f"[\x21-\x7e{LATIN}]+")
# RULES on such words: lower case, then these pieces, each byte as a character of its own
PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{LATIN}]+|[0-9]|[^a-z0-9{LATIN}]+")
SHOWN = [*range(0x21, 0x7f), *range(0xa1, 0xad), *range(0xae, 0x100)]  # bytes that stand for themselves
BYTES = {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in SHOWN)}
RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
WORDS_KEPT = 900_000  # about the bound on remembered words per worker; others are encoded again


def added_tokens(data: bytes) -> re.Pattern | None:
    """What finds the file's added tokens in a word, or None if its words are not cut by
    ``RULES`` alone."""
    file = json.loads(data)
    added = file.get("added_tokens") or []
    if (any(file.get(k) != v for k, v in RULES.items()) or file["model"].get("dropout") or file.get("truncation")
            or any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] or t["content"].isalpha() for t in added)):
        return None
    return re.compile(b"|".join(re.escape(t["content"].encode("utf-8")) for t in added) or b"(?!)")


class WordEncoder:
    def __init__(self, data: bytes):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(data.decode("utf-8"))
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}  # words of the generation before
        mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self.added = added_tokens(data)
        self.model = self.tokenizer.model

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, little-endian unsigned 32-bit."""
        out, group, size = [], [], 0
        for text in texts:
            words = text.encode("utf-8").split()
            group.append(words)
            size += len(words)
            if size > 200_000:
                out += self._encode(group)
                group, size = [], 0
        return out + self._encode(group)

    def _encode(self, group: list[list[bytes]]) -> list[bytes]:
        if len(self.known) > WORDS_KEPT // 2:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        new = set().union(*group).difference(known) if group else set()
        again = new.intersection(older)
        known.update((w, older[w]) for w in again)
        new -= again
        # a word with sentence marks behind a letter is that word, then the marks
        split, plain, one, several = [], set(), [], {}
        for w in new:
            if self.added is not None:
                if w.isalpha():  # ASCII letters
                    one.append(w)
                    continue
                text = w.decode("utf-8")
                if PLAIN.fullmatch(text) and not self.added.search(w):
                    several[w] = PIECES.findall(text.lower())
                    continue
            core = w.rstrip(MARKS)
            if core and core != w and core[-1] in LETTERS:
                split.append((w, core, w[len(core):]))
                plain.add(core)
                plain.add(w[len(core):])
            else:
                plain.add(w)
        self._learn(sorted(plain.difference(known)))
        for w, core, marks in split:
            known[w] = known[core] + known[marks]
        self._learn_pieces(one, several)
        return [b"".join(map(known.__getitem__, words)) for words in group]

    def _learn_pieces(self, one: list[bytes], several: dict[bytes, list[str]]) -> None:
        """Words of ASCII letters, which are one piece, and words with their pieces.  A
        piece is a word as well, with the ids it has there."""
        known, older, tokenize = self.known, self.older, self.model.tokenize
        lower = [w.lower() for w in one]
        cut = set().union(*several.values())
        as_bytes = {p: p.encode("utf-8") for p in cut}
        for p in set(lower).union(as_bytes.values()).difference(known):
            ids = older.get(p)
            if ids is None:
                text = p.decode("ascii") if p.isascii() else p.decode("latin-1").translate(BYTES)
                ids = array("I", [t.id for t in tokenize(text)]).tobytes()
            known[p] = ids
        known.update(zip(one, map(known.__getitem__, lower)))
        ids_of = {p: known[b] for p, b in as_bytes.items()}
        for w, pieces in several.items():
            known[w] = b"".join(map(ids_of.__getitem__, pieces))

    def _learn(self, new: list[bytes]) -> None:
        known = self.known
        alone = [w for w in new if self.mark is None or MARK.encode() in w]
        if alone:
            codes = self.tokenizer.encode_batch([w.decode("utf-8") for w in alone], add_special_tokens=False)
            known.update((w, np.asarray(e.ids, "<u4").tobytes()) for w, e in zip(alone, codes))
            new = [w for w in new if w not in known]
        between = f" {MARK} ".encode()
        for i in range(0, len(new), RUN):
            run = new[i:i + RUN]
            ids = np.asarray(self.tokenizer.encode(between.join(run).decode("utf-8"), add_special_tokens=False).ids, "<u4")
            ends = np.flatnonzero(ids == self.mark)
            lo, hi = np.r_[0, ends + 1] * 4, np.r_[ends, len(ids)] * 4
            raw = ids.tobytes()
            known.update(zip(run, [raw[x:y] for x, y in zip(lo.tolist(), hi.tolist())]))


def encoder(data: bytes) -> WordEncoder:
    """The encoder of this worker process, built once."""
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return common.worker_state(("words", hashlib.sha256(data).digest()), lambda: WordEncoder(data))
