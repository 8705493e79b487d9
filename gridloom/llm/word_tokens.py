"""Tokens of a BPE vocabulary with word ends, worked out once for each distinct run of non-blank characters.

White space never reaches a token: the pattern of the tokenizer matches none, the normalizer composes no character
with it and added tokens hold none. So a text's ids are the ids of its runs one after the other, and a run's ids can
be remembered.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from tokenizers import Tokenizer

#: Below this character, lower case is one step, composed form is the character itself and classes are listed here.
PLAIN = "ɐ"
#: The pattern of the tokenizer for characters below PLAIN.
PRE_TOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_²³¹¼½¾]+|[\d²³¹¼½¾]|(?:[^\w\s]|[_\x1c-\x1f])+")
BEYOND = re.compile(f"[{PLAIN}-\U0010ffff]")
#: White space for Python but not for the tokenizer.
SEPARATORS = re.compile("[\x1c-\x1f]")
BLANKS = re.compile(r"(?:(?![\x1c-\x1f])\s)+")


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def runs(text: str) -> list[str]:
    """The runs between white space."""
    if SEPARATORS.search(text):
        return [x for x in BLANKS.split(text) if x]
    return text.split()


def is_plain(run: str) -> bool:
    """Whether characters of a run and of its lower case are all below PLAIN."""
    return run.isascii() or not (BEYOND.search(run) or BEYOND.search(run.lower()))


def pre_tokens(run: str, added: tuple[str, ...]) -> list[str] | None:
    """What the tokenizer merges within, or None where only the library itself can tell."""
    low = run.lower()
    if max(run) >= PLAIN or max(low) >= PLAIN or any(x in run for x in added):
        return None
    return PRE_TOKEN.findall(low)


def added_strings(path: str) -> tuple[str, ...]:
    return tuple(x.content for x in tokenizer(path).get_added_tokens_decoder().values())


def library_ids(path: str, text: str) -> list[int]:
    return tokenizer(path).encode(text, add_special_tokens=False).ids
