"""License scans: Aho-Corasick over notice phrases and identifier tags, and a shunting-yard
parser for the license expressions behind the tags."""

from __future__ import annotations

import re
from functools import cache

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import map_rows

# The base phrases and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Further notice phrases, in words, and their labels.
NOTICE_PHRASES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "the mit license mit": "mit",
    "licensed under the apache license": "apache-2",
    "apache software license 2 0": "apache-2",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl-3",
    "mozilla public license version 2 0": "mpl-2",
    "mozilla public license v 2 0": "mpl-2",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "permission to use copy modify and or distribute this software": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc0 1 0 universal": "cc0",
    "all rights reserved": "reserved",
}

TAGS = ("spdx-license-identifier:", "license-expression:", "license:", "licence:")

# Identifiers (without version suffixes "-only" and "-or-later") and the label of each.
IDENTIFIERS = {
    "mit": "mit", "isc": "isc", "0bsd": "bsd", "bsd-2-clause": "bsd", "bsd-3-clause": "bsd",
    "apache-2.0": "apache-2", "unlicense": "unlicense", "cc0-1.0": "cc0", "zlib": "zlib",
    "mpl-2.0": "mpl-2", "epl-2.0": "epl-2", "lgpl-2.1": "lgpl", "lgpl-3.0": "lgpl",
    "gpl-2.0": "gpl-2", "gpl-3.0": "gpl-3", "agpl-3.0": "agpl-3", "cc-by-4.0": "cc-by",
    "cc-by-sa-4.0": "cc-by-sa", "cc-by-nc-4.0": "cc-by-nc", "cc-by-nd-4.0": "cc-by-nd",
    "cc-by-nc-sa-4.0": "cc-by-nc",
}

# How freely a text under the license may be used: 1 without conditions to speak of, 0 not at all.
FREEDOM = {
    "unlicense": 1.0, "cc0": 1.0, "mit": 0.9, "isc": 0.9, "bsd": 0.9, "zlib": 0.9, "apache-2": 0.9,
    "cc-by": 0.8, "mpl-2": 0.6, "epl-2": 0.6, "lgpl": 0.6, "cc-by-sa": 0.5, "gpl-2": 0.4, "gpl-3": 0.4,
    "agpl-3": 0.3, "cc-by-nd": 0.2, "cc-by-nc": 0.2, "reserved": 0.0,
}

# Label of a license that the identifiers do not list, where it binds.
UNKNOWN = "unknown"
# What an exception ("with") adds to the freedom of a copyleft license.
EXCEPTION_BONUS = 0.2
# Weight of one piece of evidence in the score.
EVIDENCE = {"tag": 0.9, "base": 0.8, "notice": 0.6}

BINDS = {"or": 1, "and": 2, "with": 3}
PIECE = re.compile(r"[()]|[a-z0-9][a-z0-9.+:-]*")
# Everything but digits, letters and bytes of non-ASCII characters separates words.
TO_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256)
)


def to_postfix(pieces: list[str]) -> list[str] | None:
    """Shunting-yard: infix pieces in postfix order, None if they are no expression."""
    out, waiting, operand_next = [], [], True
    for piece in pieces:
        if operand_next and piece == "(":
            waiting.append(piece)
        elif operand_next and piece not in BINDS and piece != ")":
            out.append(piece)
            operand_next = False
        elif not operand_next and piece == ")":
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        elif not operand_next and piece in BINDS:
            while waiting and BINDS.get(waiting[-1], 0) >= BINDS[piece]:
                out.append(waiting.pop())
            waiting.append(piece)
            operand_next = True
        else:
            return None
    if operand_next or "(" in waiting:
        return None
    return out + waiting[::-1]


def label_of(name: str, identifiers: dict[str, str]) -> str | None:
    return identifiers.get(re.sub(r"(-only|-or-later|\+)$", "", name))


def evaluate(postfix: list[str], identifiers: dict[str, str] = IDENTIFIERS) -> tuple[set[str], float] | None:
    """Labels of an expression and how freely it lets a text be used.

    "or" leaves the choice to the user (largest value), "and" binds to both (smallest),
    "with" grants an exception from its left side. Of a license that is not known nothing is
    permitted: "or" may pass it by, "and" gives the label UNKNOWN and no freedom. None if no
    license of the expression is known.
    """
    stack: list[tuple[set[str], float] | None] = []  # None stands for a license that is not known
    for piece in postfix:
        if piece == "with":
            exception, license_ = stack.pop(), stack.pop()
            if exception is not None:  # an exception's name is no license
                stack.append((exception[0] | (license_[0] if license_ else set()) | {UNKNOWN}, 0.0))
            elif license_ is None:
                stack.append(None)
            else:
                labels, value = license_
                stack.append((labels, min(1.0, value + EXCEPTION_BONUS) if 0 < value < 0.8 else value))
        elif piece in BINDS:
            b, a = stack.pop(), stack.pop()
            if a is None or b is None:
                known = a or b
                stack.append(known if known is None or piece == "or" else (known[0] | {UNKNOWN}, 0.0))
            else:
                stack.append((a[0] | b[0], max(a[1], b[1]) if piece == "or" else min(a[1], b[1])))
        else:
            label = label_of(piece, identifiers)
            stack.append(({label}, FREEDOM.get(label, 0.0)) if label else None)
    return stack[0]


def expression_at(line: str, identifiers: dict[str, str] = IDENTIFIERS) -> tuple[str, set[str], float] | None:
    """The longest license expression that the line starts with: text, labels, freedom.

    Only its form decides how far it reaches, not whether its licenses are known.
    """
    pieces, end, operand_next = [], 0, True
    for found in PIECE.finditer(line):
        piece = found.group()
        opens = piece not in BINDS and piece != ")"  # an identifier or an opening bracket
        if opens != operand_next or line[end : found.start()].strip(" \t\"'"):
            break
        pieces.append(piece)
        end, operand_next = found.end(), piece in BINDS or piece == "("
    while pieces and not (postfix := to_postfix(pieces)):
        pieces.pop()
    value = evaluate(postfix, identifiers) if pieces else None
    return (" ".join(pieces), *value) if value else None


@cache
def automata() -> tuple[ahocorasick.Automaton, ahocorasick.Automaton]:
    phrases, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
    for kind, group in (("notice", NOTICE_PHRASES), ("base", BASE_PHRASES)):
        for phrase, label in group.items():
            phrases.add_word(f" {phrase} ", (kind, label, len(phrase) + 2))
    for tag in TAGS:
        tags.add_word(tag, tag)
    phrases.make_automaton()
    tags.make_automaton()
    return phrases, tags


def scan_text(text: str | None, identifiers: dict[str, str] = IDENTIFIERS) -> dict:
    phrases, tags = automata()
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.translate(TO_WORDS).split()
    joined = (b" " + b" ".join(words) + b" ").decode("utf-8", "surrogatepass")
    starts, base, labels, freedoms, expressions, doubt = [], set(), set(), [], [], 1.0
    for end, (kind, label, size) in phrases.iter(joined):
        labels.add(label)
        freedoms.append(FREEDOM[label])
        doubt *= 1 - EVIDENCE[kind]
        if kind == "base":
            base.add(label)
            starts.append(end - size + 1)
    lowered = raw.lower().decode("utf-8", "surrogatepass")
    last = -1
    for end, _ in tags.iter(lowered):
        if end == last:  # the shorter tag at the end of a longer one
            continue
        last = end
        stop = lowered.find("\n", end)
        if found := expression_at(lowered[end + 1 : stop if stop >= 0 else len(lowered)], identifiers):
            expressions.append(found[0])
            labels |= found[1]
            freedoms.append(found[2])
            doubt *= 1 - EVIDENCE["tag"]
    places = []
    if starts:
        blanks = np.flatnonzero(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32) == 32)
        places = np.searchsorted(blanks, starts).tolist()
    return {
        "n_words": len(words),
        "n_base": len(places),
        "first_word": min(places, default=None),
        "last_word": max(places, default=None),
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(labels)),
        "score": 1.0 - doubt,
        "freedom": min(freedoms, default=None),
        "expressions": expressions,
    }


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", identifiers: dict[str, str] = IDENTIFIERS
) -> DataFrame:
    """License findings of every row.

    `identifiers` maps lower-cased identifiers, without "-only", "-or-later" and "+", to labels.
    An expression binds to UNKNOWN, with freedom 0, where it demands a license that is not
    listed; one without any listed license is no finding.

    Base places are where the words of a base phrase follow each other; n_base counts them
    all. `labels` adds those of further notices and of expressions behind tags. `score`
    grows with the evidence for a license statement, `freedom` is the smallest freedom that
    a finding grants (null without findings), `expressions` lists those that were parsed.
    A null text counts as empty: no words, empty labels, score 0. Rows with the same id are
    scanned each for itself; other columns are not looked at.
    """

    def scan(rows: list[dict]) -> list[dict]:
        return [{"doc_id": r["doc_id"], **scan_text(r["text"], identifiers)} for r in rows]

    return map_rows(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")),
        scan,
        f"doc_id {dict(docs.dtypes)[id_col]}, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double, freedom double, expressions array<string>",
    )
