"""Where a long text may be cut without a change to its tokens."""

from __future__ import annotations

import json
import re
from functools import lru_cache

# Letters and digits that no mark after them composes with or changes, and marks that are no part of a letter run, a
# contraction or a special string: byte-level pre-token patterns end a pre-token between the two.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ0-9а-яא-תء-غぁ-ゖァ-ヺ一-鿿가-힣"
MARKS = ".,;:!?()[]{}、。，！？；：（）「」『』《》…"
BEFORE_MARK = f"[{LETTERS}](?=[{re.escape(MARKS)}])"
# A letter or digit followed by a blank or line end: white space that follows other text starts a new pre-token.
BEFORE_BLANK = r"[^\W_](?=[ \n])"
ANY = re.compile(f"{BEFORE_BLANK}|{BEFORE_MARK}")
_RUN = r"[^\x20\x09-\x0d]"


@lru_cache(maxsize=8)
def boundary_of(tokenizer_path: str) -> re.Pattern:
    """The safe boundaries for a ``.json`` tokenizer: marks count only if none of its special strings holds one."""
    with open(tokenizer_path, encoding="utf-8") as fh:
        added = json.load(fh).get("added_tokens") or []
    held = {c for token in added for c in token["content"]}
    return re.compile(BEFORE_BLANK) if held & set(MARKS) else ANY


def cut(text: str, limit: int, boundary: re.Pattern = ANY) -> list[str]:
    """``text`` cut at the first boundary after every ``limit`` characters; what has none stays whole."""
    parts, start = [], 0
    while len(text) - start > limit:
        found = boundary.search(text, start + limit)
        if found is None:
            break
        parts.append(text[start:found.end()])
        start = found.end()
    parts.append(text[start:])
    return parts


def with_blanks(text: str, limit: int) -> str:
    """A blank at a boundary after about every ``limit`` characters of each longer run without blanks.

    For tokenizers whose pre-tokens never hold white space: the ids stay the same.
    """
    if len(text) <= limit:
        return text
    return re.sub(f"{_RUN}{{{limit + 1},}}", lambda run: " ".join(cut(run[0], limit, _MARK)), text)


_MARK = re.compile(BEFORE_MARK)
