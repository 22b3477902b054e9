"""License signatures: patterns over lower-case words, built from names and templates.

A pattern is a regular expression over words with one space between them. ``<`` stands in front
of the word that gates it; a word is optional with its space, as in ``( the)?``. Patterns have
no repetition, so the number of spaces bounds the words they can take.
"""

from __future__ import annotations

import re
from typing import NamedTuple


class Rule(NamedTuple):
    rule: int  # number in the table
    label: str
    gate: str  # the pattern is tried only where this word stands
    pattern: str
    priority: int  # the smallest wins
    confidence: float
    base: bool


# Phrases and labels fixed by the contract of the query.
BASE = {
    "<gnu general public license": "gpl",
    "<apache license": "apache",
    "<cc by": "cc-by",
    "mit <license": "mit",
}

_V = "( version| v)?"

# Label: how the license is named in running text, written by hand.
NAMES: dict[str, tuple[str, ...]] = {
    "gpl": ("<gnu gpl", "gnu public <license", "general public <license"),
    "gpl-1.0": (f"<gnu general public license{_V} 1( 0)?", f"<gpl{_V} 1( 0)?", "<gplv1"),
    "gpl-2.0": (f"<gnu general public license{_V} 2( 0)?", f"<gpl{_V} 2( 0)?", "<gplv2"),
    "gpl-2.0-or-later": (
        f"<gnu general public license{_V} 2( 0)? or( any)? later", f"<gpl{_V} 2( 0)? or( any)? later", "<gplv2 or( any)? later"),
    "gpl-3.0": (f"<gnu general public license{_V} 3( 0)?", f"<gpl{_V} 3( 0)?", "<gplv3"),
    "gpl-3.0-or-later": (
        f"<gnu general public license{_V} 3( 0)? or( any)? later", f"<gpl{_V} 3( 0)? or( any)? later", "<gplv3 or( any)? later"),
    "lgpl": ("<gnu lesser general public license", "<gnu library general public license", "<gnu lgpl"),
    "lgpl-2.0": (f"<gnu library general public license{_V} 2( 0)?", f"<lgpl{_V} 2 0"),
    "lgpl-2.1": (f"<gnu lesser general public license{_V} 2 1", f"<lgpl{_V} 2 1"),
    "lgpl-3.0": (f"<gnu lesser general public license{_V} 3( 0)?", f"<lgpl{_V} 3( 0)?", "<lgplv3"),
    "agpl-3.0": (f"<gnu affero general public license( version 3| v3)?", f"<agpl{_V} 3( 0)?", "<agplv3"),
    "gfdl": ("<gnu free documentation license",),
    "gfdl-1.2": (f"<gnu free documentation license{_V} 1 2",),
    "gfdl-1.3": (f"<gnu free documentation license{_V} 1 3",),
    "apache-1.1": (f"<apache( software)? license{_V} 1 1",),
    "apache-2.0": (f"<apache( software)? license{_V} 2( 0)?", f"<apache{_V} 2 0", "<asl 2 0"),
    "mit": ("mit x11 <license", "mit open source <license", "expat <license"),
    "bsd": ("<bsd license", "<bsd licence", "<bsd style license"),
    "bsd-2-clause": ("(2|two) clause <bsd( license)?", "simplified <bsd license", "freebsd <license"),
    "bsd-3-clause": ("(3|three) clause <bsd( license)?", "new <bsd license", "modified <bsd license"),
    "bsd-4-clause": ("(4|four) clause <bsd( license)?", "original <bsd license"),
    "0bsd": ("zero clause <bsd( license)?", "<0bsd"),
    "isc": ("isc <license", "internet systems consortium <license"),
    "mpl-1.1": (f"<mozilla public license{_V} 1 1", f"<mpl{_V} 1 1"),
    "mpl-2.0": (f"<mozilla public license{_V} 2( 0)?", f"<mpl{_V} 2 0"),
    "mpl": ("<mozilla public license",),
    "epl-1.0": (f"<eclipse public license{_V} 1( 0)?", f"<epl{_V} 1 0"),
    "epl-2.0": (f"<eclipse public license{_V} 2( 0)?", f"<epl{_V} 2 0"),
    "epl": ("<eclipse public license",),
    "cddl-1.0": ("common development and distribution <license", f"<cddl{_V} 1 0"),
    "cpl-1.0": ("common public <license",),
    "eupl": ("european union public <license( version 1 [12]| v 1 [12])?", "<eupl"),
    "unlicense": ("<unlicense",),
    "wtfpl": ("<wtfpl", "do what the fuck you want to public <license"),
    "zlib": ("zlib <license", "zlib libpng <license"),
    "boost-1.0": ("boost software <license( version 1 0)?",),
    "artistic-1.0": ("artistic <license 1 0",),
    "artistic-2.0": ("artistic <license 2 0",),
    "artistic": ("artistic <license",),
    "ofl-1.1": ("sil open font <license( version 1 1)?", "open font <license( version 1 1)?"),
    "openssl": ("openssl <license",),
    "psf-2.0": ("python software foundation <license( version 2)?", "psf <license"),
    "php-3.01": ("php <license( version 3 01)?",),
    "ruby": ("ruby <license",),
    "zpl-2.1": ("zope public <license( version 2 1)?",),
    "w3c": ("w3c software( notice and)? <license",),
    "ncsa": ("university of illinois ncsa open source <license", "ncsa open source <license"),
    "postgresql": ("postgresql <license",),
    "ms-pl": ("microsoft public <license",),
    "ms-rl": ("microsoft reciprocal <license",),
    "cecill": ("cecill( b| c)? <license",),
    "osl-3.0": ("open software <license( version)?( 3 0)?",),
    "afl-3.0": ("academic free <license( version)?( 3 0)?",),
    "odbl": ("open database <license", "<odbl"),
    "odc-by": ("open data commons attribution <license",),
    "pddl": ("public domain dedication and <license",),
    "cc-by": (f"<cc by( {{n}})?", "<creative commons attribution( license| {n} international)?"),
    "cc-by-sa": (f"<cc by sa( {{n}})?", "<creative commons attribution share ?alike( license| {n} international)?"),
    "cc-by-nc": (f"<cc by nc( {{n}})?", "<creative commons attribution non ?commercial( license| {n} international)?"),
    "cc-by-nd": (f"<cc by nd( {{n}})?", "<creative commons attribution no ?derivatives( license| {n} international)?"),
    "cc-by-nc-sa": (
        "<cc by nc sa( {n})?", "<creative commons attribution non ?commercial share ?alike( license| {n} international)?"),
    "cc-by-nc-nd": (
        "<cc by nc nd( {n})?", "<creative commons attribution non ?commercial no ?derivatives( license| {n} international)?"),
    "cc0": ("<cc0( 1 0)?( universal)?", "<creative commons zero( license)?", "<cc zero"),
    "creative-commons": ("<creative commons( license)?",),
    "public-domain": ("public <domain dedication", "(released|dedicated|placed) (in|into|to) the public <domain"),
    "proprietary": ("<proprietary( and)? confidential", "<proprietary license", "all rights <reserved"),
    "commercial": ("commercial <license", "end user <license agreement", "<eula"),
}

# Opening words of license texts and notices.
TEXTS: dict[str, tuple[str, ...]] = {
    "mit": (
        "permission is <hereby granted free of charge to any person obtaining a copy",
        "the software is provided as is without <warranty of any kind express or implied",
    ),
    "isc": ("permission to use copy modify and( or)? <distribute this software for any purpose",),
    "bsd": ("<redistribution and use in source and binary forms with or without modification",),
    "gpl": (
        "this program is free software you can <redistribute it and or modify it",
        "under the terms of the <gnu general public license",
    ),
    "lgpl": ("this library is free software you can <redistribute it and or modify it",),
    "apache-2.0": (
        "unless required by <applicable law or agreed to in writing software",
        "you may not use this file except in <compliance with the license",
    ),
    "mpl-2.0": ("this source code form is subject to the terms of the <mozilla public license( v 2 0)?",),
    "unlicense": ("this is free and <unencumbered software released into the public domain",),
    "wtfpl": ("you just do what the <fuck you want to",),
    "boost-1.0": ("permission is <hereby granted free of charge to any person or organization obtaining a copy",),
    "zlib": ("this software is provided as is without any express or implied <warranty",),
}

# Templates around a name or an identifier.
_NOTICE = (
    "(licensed|licenced|released|distributed|available|published|provided|covered|governed) (under|by|with)"
    "( the| a| an)?( terms of the| terms of| conditions of the)? "
)
_TAG = "spdx license <identifier "
_URLS = ("<opensource org licenses? ", "<spdx org licenses ")
_FIELD = "<license(s|d)?( type| name| id)? "
# Identifiers that are also everyday words are looked for in tags and addresses only.
_EVERYDAY = {"mit", "artistic", "ruby", "php", "proprietary", "commercial", "public-domain", "python", "boost-1.0"}

SPAN = 32  # most words a pattern may take


def _words(identifier: str) -> str:
    return re.sub(r"[^a-z0-9]+", " ", identifier)


def build_rules() -> list[Rule]:
    """All rules, the base phrases first. A rule more: a row in a table above."""
    found: dict[tuple[str, str], tuple[int, float, bool]] = {}

    def add(label: str, pattern: str, priority: int, confidence: float, base: bool = False) -> None:
        pattern = pattern.replace("{n}", "[1-4] [05]")
        if pattern.count(" ") + 1 > SPAN or pattern.count("<") != 1 or re.search(r"[*+{]", pattern):
            raise ValueError(f"pattern of {label}: {pattern}")
        found.setdefault((label, pattern), (priority, confidence, base))

    for phrase, label in BASE.items():
        add(label, phrase, 50, 0.8, True)
    for label, texts in TEXTS.items():
        for text in texts:
            add(label, text, 15, 0.99)
    for label, names in NAMES.items():
        for name in names:
            add(label, name, 40, 0.9)
            add(label, _NOTICE + name, 20, 0.97)
        identifier = _words(label)
        add(label, f"{_TAG}{identifier}", 10, 1.0)
        for url in _URLS:
            add(label, f"{url}{identifier}", 10, 0.99)
        if label not in _EVERYDAY:
            add(label, f"{_FIELD}{identifier}", 30, 0.85)
    gate = re.compile(r"<([a-z0-9]+)")
    return [
        Rule(n, label, gate.search(pattern).group(1), pattern, *rest)
        for n, ((label, pattern), rest) in enumerate(found.items())
    ]


RULES = build_rules()
