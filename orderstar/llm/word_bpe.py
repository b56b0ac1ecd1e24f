"""Token ids of vocabularies whose words are lower-cased, stripped of white space and end in a mark.

Same ids as the library's, faster for texts in which it is certain which characters make a word; all
others go through the library.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import cached_property, lru_cache

from .tokens import Encoder

# The published normalisation, split pattern and word end of such files.
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""
_NORMALIZED = ["NFC", "Replace", "Lowercase"]
_WORD_END = "</w>"

# Control characters, combining marks, letters whose lower case depends on what follows or takes two
# characters, and everything above the scripts on which the libraries' classes agree.
_UNUSUAL = re.compile("[^\t\n\r -~¡-įı-˿Ͱ-΢Τ-҂Ҋ-԰]")
_LONG_RUN = re.compile(r"[^\W\d_]{20000}|[^\s\w]{20000}")


@lru_cache(maxsize=1)
def word_encoder(path: str) -> Encoder:
    """One encoder per Python worker; files of another kind get the general one."""
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    steps = (described["normalizer"] or {}).get("normalizers", [])
    before = (described["pre_tokenizer"] or {}).get("pretokenizers", [])
    model = described["model"]
    known = (
        [s["type"] for s in steps] == _NORMALIZED
        and steps[1]["pattern"] == {"Regex": r"\s+"}
        and steps[1]["content"] == " "
        and [s["type"] for s in before] == ["Split", "ByteLevel"]
        and before[0]["pattern"] == {"Regex": _SPLIT}
        and (before[0]["behavior"], before[0]["invert"]) == ("Removed", True)
        and not (before[1]["use_regex"] or before[1]["add_prefix_space"])
        and model["type"] == "BPE"
        and model["end_of_word_suffix"] == _WORD_END
        and not any(model[c] for c in ("dropout", "byte_fallback", "ignore_merges"))
    )
    return WordEncoder(path) if known else Encoder(path)


def _usual_words() -> re.Pattern:
    """The split pattern for lower-cased usual text, its classes spelled out: twice as fast."""
    import regex

    usual = {chr(c) for c in range(0x600) if not _UNUSUAL.match(chr(c))}
    lowered = sorted(usual | {c for own in usual for c in own.lower()})

    def spelled(kind: str) -> str:
        return "".join(re.escape(c) for c in lowered if regex.match(kind, c))

    letters, numbers = spelled(r"\p{L}"), spelled(r"\p{N}")
    return re.compile(
        f"[{letters}]+|'(?:s|t|re|ve|m|ll|d)|[{numbers}]|[^\\s{letters}{numbers}]+"
    )


class WordEncoder(Encoder):
    """Words are cut out in Python and merged by byte ranks; a zero byte stands for the word's end."""

    def __init__(self, path: str):
        super().__init__(path)
        # A space before an ASCII letter ends a word whatever stands around it.
        self._may_cut = not (self.special and " " in self.special.pattern)
        self._words = _usual_words().findall

    @cached_property
    def _ranked(self):
        """None if the merges are not numbered in their order."""
        import tiktoken

        with open(self.path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        hidden = [b for b in range(256) if b not in shown]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {}
        for piece, number in model["vocab"].items():
            ends = len(piece) > len(_WORD_END) and piece.endswith(_WORD_END)
            body = piece.removesuffix(_WORD_END) if ends else piece
            ranks[bytes(byte[c] for c in body) + b"\0" * ends] = number
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        numbers = [model["vocab"].get(a + b, -1) for a, b in pairs]
        # The end has to join its byte before any merge: those numbers must be the lower ones.
        single = [n for piece, n in ranks.items() if len(piece.removesuffix(b"\0")) <= 1]
        if len(ranks) < len(model["vocab"]) or numbers != sorted(set(numbers)):
            return None
        if len(single) != 512 or (numbers and numbers[0] <= max(single)):
            return None
        return tiktoken.Encoding(
            "words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary

    def _ids(self, text: str) -> list[int]:
        usual = not (_UNUSUAL.search(text) or self.special and self.special.search(text))
        usual = usual and not _LONG_RUN.search(text) and self._ranked is not None
        if not usual or not (text.isascii() or unicodedata.is_normalized("NFC", text)):
            return self.library.encode(text, add_special_tokens=False).ids
        words = self._words(text.lower())
        return self._ranked("\0".join([*words, ""])) if words else []
