import pytest

from cohort_risk.llm import licenses
from cohort_risk.llm.license_texts import TEMPLATES
from cohort_risk.llm.words import words

from .conftest import long_text

INDEX = licenses.Index(TEMPLATES)


def names(text):
    return [h["license"] for h in licenses.find([text], INDEX)[0]]


@pytest.mark.parametrize("text, want", [
    ("Released under an MIT License", ["MIT notice"]),
    ("They said: licensed under the MIT License, all of it", ["MIT notice"]),
    ("Released under the Zlib License", []),
    ("This work is licensed under the GNU General Public License, version 2.", ["GPL-2.0 notice"]),
    ("This work is licensed under the GNU General Public License, version 4.", []),
    ("Licensed under the Apache License, Version 1.1.", ["Apache-1.1 notice"]),
    ("Licensed under the Apache License, Version 2.1.", []),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", ["CC-BY-SA-4.0 notice"]),
    ("This work is licensed under a Creative Commons Attribution 3.0 International License.", []),
    ("Licensed under CC BY-NC-ND 4.0.", []),
    (TEMPLATES["GPL-3.0 header"].replace("version 3", "version 2"), ["GPL-2.0 header"]),
])
def test_names_and_versions_are_exact(text, want):
    assert names(text) == want


def edits(found):
    for i in range(len(found)):
        yield found[:i] + ["zebra"] + found[i + 1:]
        yield found[:i] + found[i + 1:]
        yield found[:i] + ["zebra"] + found[i:]
        for j in range(i + 1, len(found)):
            yield found[:i] + ["zebra"] + found[i + 1:j] + ["yak"] + found[j + 1:]


def test_edited_notices_as_by_full_alignment():
    """Without an index or a band: every template against the whole text."""
    lost, n = [], 0
    for name in TEMPLATES:
        if len(INDEX.words[INDEX.names.index(name)]) > 12:
            continue
        for edit in edits(words_of(TEMPLATES[name])):
            text = f"{long_text(1, 9)} {' '.join(edit)} {long_text(2, 9)}"
            n += 1
            if by_full_alignment(text, name) and name not in names(text):
                lost.append((name, text))
    assert n > 300 and not lost


def words_of(text):
    found, raw = words([text], fold=True), text.encode()
    return [raw[a:b].decode() for a, b in zip(found.starts, found.ends)]


def by_full_alignment(text, name):
    k, body = INDEX.names.index(name), words([text], fold=True).hashes
    template = INDEX.words[k]
    matched, first, last = licenses.align(template, body, -len(template), len(body))
    span = body[first:last + 1].tolist()
    return (matched >= licenses.LEAST_COVERAGE * len(template) and not INDEX.foreign[k].intersection(span)
            and all(any(span[i:i + len(x)] == x for i in range(len(span))) for x in INDEX.required[k]))
