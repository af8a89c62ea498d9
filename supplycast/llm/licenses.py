"""License scan: an Aho-Corasick automaton for phrases and a shunting-yard parser for tag expressions.

Texts are read as words (letters, digits and everything beyond ASCII, A-Z lower-cased) joined by single
blanks, so that one automaton finds all phrases in one pass whatever the punctuation between their
words.  Where it meets an identifier tag, the expression that follows the tag in the text is parsed
with the precedence WITH, AND, OR and adds the labels of its operands.
"""

from __future__ import annotations

import functools
import re
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: fixed values: phrases that count as base places
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

#: fixed values: further notice phrases and the label each one stands for
NOTICE_PHRASES = {
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "bsd license": "bsd",
    "isc license": "isc",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit",
    "licensed under the mit": "mit",
    "licensed under the apache": "apache",
    "creative commons": "cc",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
    "public domain": "public-domain",
    "all rights reserved": "proprietary",
    "proprietary and confidential": "proprietary",
}

TAG = "spdx license identifier"

#: fixed values: families of identifiers by their prefix
FAMILIES = {
    "mit": "mit",
    "apache": "apache",
    "agpl": "agpl",
    "lgpl": "lgpl",
    "gpl": "gpl",
    "bsd": "bsd",
    "isc": "isc",
    "mpl": "mpl",
    "epl": "epl",
    "cc0": "cc0",
    "cc-by-sa": "cc-by-sa",
    "cc-by-nc": "cc-by-nc",
    "cc-by-nd": "cc-by-nd",
    "cc-by": "cc-by",
    "unlicense": "public-domain",
}

#: fixed values: how freely texts under a label may be used, from 0 to 1
OPENNESS = {
    "public-domain": 1.0,
    "cc0": 1.0,
    "mit": 1.0,
    "isc": 1.0,
    "bsd": 1.0,
    "apache": 1.0,
    "cc-by": 0.9,
    "cc-by-sa": 0.6,
    "mpl": 0.6,
    "epl": 0.6,
    "cc": 0.5,
    "lgpl": 0.5,
    "gpl": 0.3,
    "agpl": 0.3,
    "cc-by-nd": 0.2,
    "cc-by-nc": 0.1,
    "proprietary": 0.0,
}
#: fixed values: identifiers in use that carry neither a version nor a family above
PLAIN_IDENTIFIERS = frozenset(
    "0bsd beerware blessing curl fsfap ftl icu ijg intel libtiff ncsa ntp openssl php postgresql psf"
    " python ruby sleepycat tcl vim wtfpl x11 xnet zlib".split()
)
#: of an identifier without family, and of a text without any label
UNKNOWN = 0.5

_PRECEDENCE = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"\(|\)|[a-z0-9][a-z0-9.+-]*")
_VERSIONED = re.compile(r"(?:licenseref-[a-z0-9.-]+|[a-z][a-z0-9]*(?:-[a-z0-9]+)*-v?[0-9]+(?:\.[0-9]+)*(?:-[a-z]+)*)\+?")
_SEPARATORS = bytes(c for c in range(128) if not chr(c).isalnum())
_NORMAL = bytes(
    0x20 if c in _SEPARATORS else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256)
)
_TAG_AT = re.compile(r"spdx[^\w\n]*license[^\w\n]*identifier[ \t]*:?([^\n]*)", re.ASCII)


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_NORMAL).split(b" ")


def family(identifier: str) -> str:
    """Family label of an identifier, the identifier itself where the family is unknown."""
    name = identifier.rstrip("+")
    parts = name.split("-")
    for n in range(len(parts), 0, -1):
        if (label := FAMILIES.get("-".join(parts[:n]))) is not None:
            return label
    return name


def is_identifier(token: str) -> bool:
    """A known family or name, or the shape of a versioned identifier such as ``ofl-1.1``."""
    return (
        family(token) in OPENNESS or token in PLAIN_IDENTIFIERS or _VERSIONED.fullmatch(token) is not None
    )


def to_postfix(expression: str) -> list[str] | None:
    """Postfix form of a lower-case licence expression by the shunting-yard method.

    Reading stops at the first token that cannot continue the expression (prose after the tag); None
    if no complete expression stands there.  The first operand is what the tag names, whatever it is;
    later ones must look like identifiers (``is_identifier``), so that "mit and others" is ``mit``.
    """
    tokens, output, stack, operand_next = _TOKEN.findall(expression), [], [], True
    good: list[str] | None = None
    for token in tokens:
        if operand_next:
            if token == "(":
                stack.append(token)
                continue
            if token == ")" or token in _PRECEDENCE:
                break
            if output and not is_identifier(token) and stack[-1:] != ["with"]:
                break
            output.append(token)
            operand_next = False
        elif token in _PRECEDENCE:
            while (
                stack and stack[-1] != "(" and _PRECEDENCE[stack[-1]] >= _PRECEDENCE[token]
            ):
                output.append(stack.pop())
            stack.append(token)
            operand_next = True
        elif token == ")":
            while stack and stack[-1] != "(":
                output.append(stack.pop())
            if not stack:
                break
            stack.pop()
        else:
            break
        if not operand_next and "(" not in stack:
            good = output + stack[::-1]
    return good


def evaluate(postfix: list[str]) -> tuple[frozenset[str], float]:
    """Labels of all licences in the expression and the openness of the whole.

    ``or`` lets the user choose the most open side, ``and`` binds to the least open one; an exception
    (``with``) changes neither the labels nor the openness of its licence.
    """
    stack: list[tuple[frozenset[str], float]] = []
    for token in postfix:
        if token not in _PRECEDENCE:
            label = family(token)
            stack.append((frozenset([label]), OPENNESS.get(label, UNKNOWN)))
            continue
        (right, b), (left, a) = stack.pop(), stack.pop()
        if token == "with":
            stack.append((left, a))
        else:
            stack.append((left | right, max(a, b) if token == "or" else min(a, b)))
    return stack[0]


@functools.cache
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for phrase in {*BASE_PHRASES, *NOTICE_PHRASES, TAG}:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def scan(text: str | None) -> tuple:
    """``(n_words, n_base, first_word, last_word, base_labels, labels, score)`` of one text.

    A place is a phrase at a word position; two phrases there are two places.  Empty and null texts
    have no words, no labels and the score of an unknown licence.
    """
    words = [w for w in normal_words(text) if w]
    joined = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "
    blanks: list[int] = []
    base, more, scores, tagged = set(), set(), [], False
    for end, phrase in _automaton().iter(joined):
        if phrase in BASE_PHRASES:
            blanks.append(end - len(phrase) - 1)
            base.add(BASE_PHRASES[phrase])
            more.add(BASE_PHRASES[phrase])
        elif phrase == TAG:
            tagged = True
        else:
            more.add(NOTICE_PHRASES[phrase])
    # the blank before a word has as many blanks before it as the word has words
    blanks.sort()
    steps = zip([0, *blanks], blanks)
    at = list(accumulate(joined.count(" ", before, here) for before, here in steps))
    scores += [OPENNESS[label] for label in more]
    if tagged:
        for tag in _TAG_AT.finditer(text.lower()):
            if (postfix := to_postfix(tag[1])) is not None:
                labels, openness = evaluate(postfix)
                more |= labels
                scores.append(openness)
    return (
        len(words),
        len(at),
        min(at, default=None),
        max(at, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(more)),
        min(scores, default=UNKNOWN),
    )


_FIELDS = (
    ("n_words", T.LongType(), pa.int64()),
    ("n_base", T.LongType(), pa.int64()),
    ("first_word", T.LongType(), pa.int64()),
    ("last_word", T.LongType(), pa.int64()),
    ("base_labels", T.StringType(), pa.string()),
    ("labels", T.StringType(), pa.string()),
    ("score", T.DoubleType(), pa.float64()),
)


def licenses_of(text: str = "text") -> Column:
    """Struct with the result of ``scan`` for every row; other columns do not matter.

    ``score`` is the openness of the least open licence found, 0.5 where none was found.
    """

    def run(column: pa.Array) -> pa.Array:
        rows = zip(*(scan(t.as_py()) for t in column), strict=True) if len(column) else [()] * 7
        return pa.StructArray.from_arrays(
            [pa.array(v, kind) for v, (_, _, kind) in zip(rows, _FIELDS, strict=True)],
            names=[name for name, _, _ in _FIELDS],
        )

    kind = T.StructType([T.StructField(name, t) for name, t, _ in _FIELDS])
    return F.arrow_udf(run, kind)(F.col(text))
