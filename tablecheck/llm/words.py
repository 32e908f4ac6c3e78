"""Words of letters and digits, as the search and the decontamination read them.

A word is a longest run of ASCII letters, ASCII digits and characters beyond ASCII, with
A to Z lower-cased and nothing else changed. In UTF-8 all bytes of a character beyond ASCII
are 0x80 or more, so bytes can be split without decoding them.
"""

from __future__ import annotations

_TABLE = bytes(
    b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower()
)


def words_of(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text."""
    return text.translate(_TABLE).split()


def word_places(text: bytes) -> list[tuple[int, int]]:
    """Where each word starts and ends, in bytes."""
    places, end = [], 0
    blank = text.translate(_TABLE)
    for word in blank.split():
        start = blank.index(word, end)
        end = start + len(word)
        places.append((start, end))
    return places
