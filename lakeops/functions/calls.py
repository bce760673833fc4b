"""Translation of function calls with nested arguments.

Balanced parentheses are beyond a regular expression, so the texts that hold
such a call, and only those, pass through an Arrow batch function.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The batch function travels with the plan, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Each function that needs a new spelling, by its argument count
# (None: any), with the text that replaces the call.
CALLS = {
    ("ZEROIFNULL", None): "COALESCE({all}, 0)",
    ("REGEXP_REPLACE", 2): "REGEXP_REPLACE({0}, {1}, '')",
    ("IFF", 3): "CASE WHEN {0} THEN {1} ELSE {2} END",
    ("TO_VARCHAR", 1): "CAST({0} AS STRING)",
}

_NAMES = "|".join(sorted({name for name, _ in CALLS}))
_MENTIONED = rf"(?i)\b(?:{_NAMES})\s*\("
# What the scan stops at. Strings, quoted names and comments are single tokens,
# so a parenthesis or comma inside them is text; one that is not closed runs to
# the end of the text, so no part of it is scanned twice.
_TOKEN = re.compile(
    rf"""'[^']*(?:''[^']*)*(?:'|\Z) | "[^"]*(?:"|\Z) | --[^\n]* | /\*.*?(?:\*/|\Z)
      | (?<![\w.])(?P<name>{_NAMES})\s*\( | (?P<open>\() | (?P<comma>,) | (?P<close>\))""",
    re.IGNORECASE | re.DOTALL | re.VERBOSE,
)


def _stripped(out: list[str], begin: int, end: int) -> bool:
    """Blank out the white space at both ends of the pieces of one argument; whether anything is left."""
    for places, strip in ((range(begin, end), str.lstrip), (range(end - 1, begin - 1, -1), str.rstrip)):
        for k in places:
            out[k] = strip(out[k])
            if out[k]:
                break
        else:
            return False
    return True


def _edit(out: list[str], name: str, begin: int, commas: list[int]) -> bool:
    """Write the new spelling of a call into its own marks; its arguments' pieces stay where they are.

    ``begin`` and ``commas`` are the places of the opening mark and of the commas, and the closing one is the last.
    """
    marks = [begin, *commas, len(out) - 1]
    shape = CALLS.get((name, len(marks) - 1))
    whole = None if shape else CALLS.get((name, None))
    arguments = [(a + 1, b) for a, b in zip(marks, marks[1:])]
    if not (shape or whole) or not all(any(out[k].strip() for k in range(a, b)) for a, b in arguments):
        return False
    if whole:
        out[begin], out[-1] = whole.split("{all}")
        return True
    for a, b in arguments:
        _stripped(out, a, b)
    for place, text in zip(marks, re.split(r"\{\d\}", shape)):
        out[place] = text
    return True


def translate_text(sql: str) -> str:
    """Translate every complete call, innermost first, in one scan of the text.

    A call is edited where its marks stand in one list of pieces, which is
    joined once: no nested text is copied.
    """
    out: list[str] = []
    # Each open parenthesis: function name or "", the place of its mark, the places of its commas.
    calls: list[tuple[str, int, list[int]]] = []
    seen = 0
    for token in _TOKEN.finditer(sql):
        if token.start() > seen:
            out.append(sql[seen : token.start()])
        out.append(token[0])
        seen = token.end()
        if token["name"] or token["open"]:
            calls.append(((token["name"] or "").upper(), len(out) - 1, []))
        elif token["comma"] and calls:
            calls[-1][2].append(len(out) - 1)
        elif token["close"] and calls:
            name, begin, commas = calls.pop()
            if name:
                _edit(out, name, begin, commas)
    out.append(sql[seen:])
    return "".join(out)


@F.arrow_udf(T.StringType())
def _translate_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """One text at a time: a worker holds the batch as it came, a single text, and the bytes of the batch that goes back."""
    for texts in batches:
        written, ends = pa.BufferOutputStream(), np.zeros(len(texts) + 1, np.int32)
        for k, text in enumerate(texts):
            if text.is_valid:
                written.write(translate_text(text.as_py()).encode())
            ends[k + 1] = written.tell()
        yield pa.Array.from_buffers(pa.string(), len(texts), [texts.is_valid().buffers()[1], pa.py_buffer(ends), written.getvalue()])


def translate_functions(text: Column) -> Column:
    """Rewrite the calls listed in ``CALLS``; other text is returned untouched."""
    return F.coalesce(_translate_batches(F.when(text.rlike(_MENTIONED), text)), text)
