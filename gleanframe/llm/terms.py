"""Words of a text's bytes, for tasks that run in Python."""

from __future__ import annotations

import re
import sys

from pyspark import cloudpickle

# workers may lack this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: After A-Z are lower-cased: digits, letters and every byte of characters beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
TO_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def byte_words(text: bytes | None) -> list[bytes]:
    """Maximal runs of ASCII digits, letters and characters beyond ASCII, A-Z lower-cased; none for null."""
    return WORD.findall((text or b"").translate(TO_LOWER))
