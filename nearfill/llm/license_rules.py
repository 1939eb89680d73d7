"""Signature rules for licence texts, notices, names and tags.

Rules read a text's words: ASCII lower case, maximal runs of letters, digits and
non-ASCII characters, joined by one space.  So "GPL-3.0+" reads "gpl 3 0".  A
rule's pattern starts at its anchor word; the anchors are the keyword prefilter.
Priorities: 4 tag, 3 text or notice, 2 name with version, 1 bare name.
"""
from __future__ import annotations

import re
from dataclasses import dataclass

TAG, NOTICE, NAMED, BARE = 4, 3, 2, 1
#: How sure a detection of each priority is, 0 to 1.
CONFIDENCE = {TAG: 1.0, NOTICE: 0.95, NAMED: 0.85, BARE: 0.6}
#: Words of context that a rule may read from its anchor on.
WINDOW_WORDS = 32


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    anchor: str
    pattern: str
    base: bool = False

    @property
    def needs(self) -> str:
        """The longest run of characters that every match holds, a cheap test before the pattern."""
        depth, runs, run = 0, [], ""
        for ch in re.sub(r"\[[^\]]*\]|\{[^}]*\}|\.", "(", self.pattern.replace("(?:", "<").replace(")", ">")):
            if ch in "<>(?":
                runs.append(run[:-1] if ch == "?" else run)
                depth += (ch == "<") - (ch == ">")
                run = ""
            elif not depth:
                run += ch
        return max([*runs, run], key=len)


#: The base phrases and their labels.
BASE = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)

_LATER = "(?:any later version|or later|or newer|or any later version)"

# SPDX ids (words as read above) that stand after "spdx license identifier" and in bare tags
_SPDX = (
    "0bsd", "afl 3 0", "agpl 1 0", "agpl 3 0", "agpl 3 0 only", "agpl 3 0 or later", "apache 1 0", "apache 1 1", "apache 2 0",
    "apsl 2 0", "artistic 1 0", "artistic 2 0", "blueoak 1 0 0", "bsd 1 clause", "bsd 2 clause", "bsd 2 clause patent",
    "bsd 3 clause", "bsd 3 clause clear", "bsd 4 clause", "bsl 1 0", "busl 1 1", "cc by 1 0", "cc by 2 0", "cc by 2 5",
    "cc by 3 0", "cc by 4 0", "cc by nc 2 0", "cc by nc 3 0", "cc by nc 4 0", "cc by nc nd 3 0", "cc by nc nd 4 0",
    "cc by nc sa 3 0", "cc by nc sa 4 0", "cc by nd 3 0", "cc by nd 4 0", "cc by sa 2 5", "cc by sa 3 0", "cc by sa 4 0",
    "cc0 1 0", "cddl 1 0", "cddl 1 1", "cecill 2 1", "cecill b", "cecill c", "cpal 1 0", "cpl 1 0", "ecl 2 0", "epl 1 0",
    "epl 2 0", "eupl 1 1", "eupl 1 2", "gfdl 1 2", "gfdl 1 3", "gpl 1 0", "gpl 1 0 only", "gpl 1 0 or later", "gpl 2 0",
    "gpl 2 0 only", "gpl 2 0 or later", "gpl 3 0", "gpl 3 0 only", "gpl 3 0 or later", "hpnd", "isc", "lgpl 2 0", "lgpl 2 1",
    "lgpl 2 1 only", "lgpl 2 1 or later", "lgpl 3 0", "lgpl 3 0 only", "lgpl 3 0 or later", "lppl 1 3c", "mit", "mit 0",
    "mpl 1 0", "mpl 1 1", "mpl 2 0", "ms pl", "ms rl", "mulanpsl 2 0", "ncsa", "odbl 1 0", "ofl 1 1", "openssl", "osl 3 0",
    "php 3 01", "postgresql", "psf 2 0", "python 2 0", "sspl 1 0", "unlicense", "upl 1 0", "vim", "w3c", "wtfpl", "x11",
    "zlib", "zpl 2 1",
)

# (label stem, its usual long names as patterns, versions)
_VERSIONED = (
    ("gpl", r"gnu (?:general public license|gpl)|general public license|gplv?", ("1 0", "2 0", "3 0")),
    ("lgpl", r"gnu (?:lesser|library) general public license|(?:lesser|library) general public license|lgplv?", ("2 0", "2 1", "3 0")),
    ("agpl", r"gnu affero general public license|affero general public license|agplv?", ("1 0", "3 0")),
    ("gfdl", r"gnu free documentation license|gfdlv?", ("1 1", "1 2", "1 3")),
    ("apache", r"apache (?:software )?license|apache", ("1 0", "1 1", "2 0")),
    ("mpl", r"mozilla public license|mpl", ("1 0", "1 1", "2 0")),
    ("epl", r"eclipse public license|epl", ("1 0", "2 0")),
    ("cddl", r"common development and distribution license|cddl", ("1 0", "1 1")),
    ("eupl", r"european union public licen[cs]e|eupl", ("1 0", "1 1", "1 2")),
    ("artistic", r"artistic license|perl artistic license", ("1 0", "2 0")),
    ("osl", r"open software license|osl", ("1 0", "2 0", "2 1", "3 0")),
    ("afl", r"academic free license|afl", ("2 0", "2 1", "3 0")),
    ("ofl", r"sil open font license|open font license|ofl", ("1 0", "1 1")),
    ("odbl", r"open database license|odbl", ("1 0",)),
    ("bsl", r"boost software license|bsl", ("1 0",)),
    ("sspl", r"server side public license|sspl", ("1 0",)),
    ("busl", r"business source license|busl", ("1 0", "1 1")),
    ("cpl", r"common public license|cpl", ("0 5", "1 0")),
    ("ecl", r"educational community license|ecl", ("1 0", "2 0")),
    ("zpl", r"zope public license|zpl", ("1 1", "2 0", "2 1")),
    ("cecill", r"cecill", ("1 0", "1 1", "2 0", "2 1")),
    ("php", r"php license|php", ("3 0", "3 01")),
    ("lppl", r"latex project public license|lppl", ("1 0", "1 2", "1 3c")),
    ("mulanpsl", r"mulan permissive software license|mulan psl", ("1 0", "2 0")),
    ("upl", r"universal permissive license|upl", ("1 0",)),
    ("cpal", r"common public attribution license|cpal", ("1 0",)),
    ("apsl", r"apple public source license|apsl", ("1 0", "1 1", "1 2", "2 0")),
    ("ipl", r"ibm public license", ("1 0",)),
    ("spl", r"sun public license", ("1 0",)),
    ("nasa", r"nasa open source agreement", ("1 3",)),
)

# Creative Commons: element codes, their words, versions
_CC = (("by", "attribution"), ("by-sa", "attribution share ?alike"), ("by-nd", "attribution no ?deriv(?:ative)?s?"),
       ("by-nc", "attribution non ?commercial"), ("by-nc-sa", "attribution non ?commercial share ?alike"),
       ("by-nc-nd", "attribution non ?commercial no ?deriv(?:ative)?s?"))
_CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")

# Unversioned names, texts and notices: (label, priority, pattern); the first word is the anchor
_HAND = (
    ("gpl", BARE, "gnu general public license"),
    ("gpl", BARE, "gnu gpl"),
    ("gpl", BARE, "general public license"),
    ("gpl", BARE, "gpl (?:compatible )?licen[cs]ed?"),
    ("gpl", NOTICE, "terms of the gnu general public license"),
    ("gpl", NOTICE, "free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", NOTICE, "received a copy of the gnu general public license"),
    ("gpl-2.0-or-later", NOTICE, "terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl-3.0-or-later", NOTICE, "terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("lgpl", BARE, "gnu (?:lesser|library) general public license"),
    ("lgpl", BARE, "gnu lgpl"),
    ("lgpl", NOTICE, "received a copy of the gnu lesser general public license"),
    ("lgpl", NOTICE, "terms of the gnu (?:lesser|library) general public license"),
    ("agpl", BARE, "gnu affero general public license"),
    ("agpl", BARE, "gnu agpl"),
    ("agpl", NOTICE, "received a copy of the gnu affero general public license"),
    ("agpl", NOTICE, "terms of the gnu affero general public license"),
    ("gfdl", BARE, "gnu free documentation license"),
    ("apache", BARE, "apache (?:software )?licen[cs]ed?"),
    ("apache-2.0", NOTICE, "licensed under the apache license version 2 0"),
    ("apache-2.0", NOTICE, "apache license version 2 0 january 2004"),
    ("apache-2.0", NOTICE, "compliance with the license you may obtain a copy of the license at https? www apache org licenses license 2 0"),
    ("apache-2.0", NOTICE, "http www apache org licenses license 2 0"),
    ("apache-2.0", NOTICE, "https www apache org licenses license 2 0"),
    ("mit", BARE, "mit licen[cs]e"),
    ("mit", BARE, "mit licen[cs]ed"),
    ("mit", NAMED, "mit expat licen[cs]e"),
    ("mit", NAMED, "expat licen[cs]e"),
    ("mit", NOTICE, "released under the mit licen[cs]e"),
    ("mit", NOTICE, "licensed under the mit licen[cs]e"),
    ("mit", NOTICE, "distributed under the mit licen[cs]e"),
    ("mit", NOTICE, "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", NOTICE, "http (?:www )?opensource org licenses mit"),
    ("mit", NOTICE, "https (?:www )?opensource org licenses mit"),
    ("mit-0", NAMED, "mit no attribution"),
    ("bsd", BARE, "bsd (?:style )?licen[cs]ed?"),
    ("bsd-2-clause", NAMED, "bsd 2 clause"),
    ("bsd-3-clause", NAMED, "bsd 3 clause"),
    ("bsd-4-clause", NAMED, "bsd 4 clause"),
    ("bsd-2-clause", NAMED, "(?:simplified|freebsd) bsd licen[cs]e"),
    ("bsd-3-clause", NAMED, "(?:new|modified|revised) bsd licen[cs]e"),
    ("0bsd", NAMED, "zero clause bsd"),
    ("0bsd", NAMED, "bsd zero clause"),
    ("bsd", NOTICE, "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", NOTICE, "contributors may be used to endorse or promote products"),
    ("bsd-2-clause", NOTICE, "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-4-clause", NOTICE, "advertising materials mentioning features or use of this software must display"),
    ("isc", BARE, "isc licen[cs]e"),
    ("isc", NOTICE, "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("hpnd", NOTICE, "permission to use copy modify and distribute this software and its documentation for any purpose"),
    ("zlib", BARE, "zlib(?: libpng)? licen[cs]e"),
    ("zlib", NOTICE, "altered source versions must be plainly marked as such"),
    ("bsl-1.0", BARE, "boost software license"),
    ("mpl", BARE, "mozilla public license"),
    ("mpl-2.0", NOTICE, "subject to the terms of the mozilla public license v 2 0"),
    ("mpl-1.1", NOTICE, "subject to the mozilla public license version 1 1"),
    ("epl", BARE, "eclipse public license"),
    ("epl-2.0", NOTICE, "terms of the eclipse public license v(?:ersion)? ?2 0"),
    ("epl-1.0", NOTICE, "terms of the eclipse public license v(?:ersion)? ?1 0"),
    ("cddl", BARE, "common development and distribution license"),
    ("eupl", BARE, "european union public licen[cs]e"),
    ("artistic", BARE, "artistic license"),
    ("unlicense", BARE, "unlicense"),
    ("unlicense", NOTICE, "free and unencumbered software released into the public domain"),
    ("unlicense", NOTICE, "https? unlicense org"),
    ("public-domain", BARE, "public domain"),
    ("public-domain", NOTICE, "dedicated to the public domain"),
    ("public-domain", NOTICE, "released into the public domain"),
    ("public-domain", NOTICE, "placed in the public domain"),
    ("wtfpl", BARE, "wtfpl"),
    ("wtfpl", NOTICE, "fuck you want to public license"),
    ("beerware", BARE, "beerware"),
    ("beerware", NOTICE, "beer ware license"),
    ("cc0", BARE, "cc0"),
    ("cc0-1.0", NOTICE, "creative commons zero"),
    ("cc0-1.0", NOTICE, "creativecommons org publicdomain zero 1 0"),
    ("cc-pdm", NOTICE, "creativecommons org publicdomain mark 1 0"),
    ("cc", BARE, "creative commons licen[cs]e"),
    ("cc", BARE, "creative commons"),
    ("cc-by", BARE, "cc by"),
    ("cc-by-sa", BARE, "cc by sa"),
    ("cc-by-nc", BARE, "cc by nc"),
    ("cc-by-nd", BARE, "cc by nd"),
    ("cc-by-nc-sa", BARE, "cc by nc sa"),
    ("cc-by-nc-nd", BARE, "cc by nc nd"),
    ("openssl", BARE, "openssl license"),
    ("openssl", NOTICE, "software developed by the openssl project"),
    ("python", BARE, "python software foundation license"),
    ("python", BARE, "psf license"),
    ("ruby", BARE, "ruby license"),
    ("vim", BARE, "vim license"),
    ("postgresql", BARE, "postgresql license"),
    ("curl", BARE, "curl license"),
    ("ncsa", BARE, "university of illinois ncsa open source license"),
    ("ncsa", BARE, "ncsa open source license"),
    ("x11", BARE, "x11 license"),
    ("x11", BARE, "mit x11 licen[cs]e"),
    ("w3c", BARE, "w3c software notice and license"),
    ("json", NOTICE, "software shall be used for good not evil"),
    ("commons-clause", NOTICE, "commons clause license condition"),
    ("elastic-2.0", NAMED, "elastic license 2 0"),
    ("elastic", BARE, "elastic license"),
    ("ms-pl", BARE, "microsoft public license"),
    ("ms-rl", BARE, "microsoft reciprocal license"),
    ("open-government", BARE, "open government licen[cs]e"),
    ("odc-by", BARE, "open data commons attribution license"),
    ("pddl", BARE, "public domain dedication and license"),
    ("llama", BARE, "llama [0-9 ]{0,4}community license"),
    ("openrail", BARE, "openrail"),
    ("openrail", BARE, "responsible ai license"),
    ("proprietary", NOTICE, "rights reserved"),
    ("proprietary", NOTICE, "proprietary and confidential"),
    ("proprietary", NOTICE, "unauthorized copying of this file"),
)


def _alternatives(pattern: str) -> list[str]:
    """Top-level alternatives of a pattern."""
    out, depth, part = [], 0, ""
    for ch in pattern:
        depth += (ch == "(") - (ch == ")")
        if ch == "|" and not depth:
            out.append(part)
            part = ""
        else:
            part += ch
    return [*out, part]


def _rule(label: str, priority: int, pattern: str, base: bool = False) -> list[Rule]:
    """The rule once for each anchor word that its pattern can begin with."""
    out = []
    for alternative in _alternatives(pattern):
        if alternative.startswith("(?:"):
            choice, _, rest = alternative[3:].partition(")")
            heads = [w + rest for w in choice.split("|")]
        else:
            heads = [alternative]
            if m := re.match(r"([a-z0-9]+)([a-z0-9])\? ", alternative):
                heads = [m[1] + m[2] + alternative[m.end() - 1:], m[1] + alternative[m.end() - 1:]]
        out += [Rule(label, priority, re.match("[a-z0-9]+", h)[0], h, base) for h in heads]
    return out


def rules() -> list[Rule]:
    """All rules, in order: of two equal detections the earlier rule's stays."""
    out = []
    for label, phrase in BASE:
        out += _rule(label, BARE, phrase, base=True)
    for words in _SPDX:
        out += _rule(spdx_label(words), TAG, f"spdx license identifier {words}")
    for stem, names, versions in _VERSIONED:
        for version in versions:
            major, minor = version.split(" ")
            number = f"{major}(?: {minor})?" if minor == "0" else f"{major} {minor}"
            label = f"{stem}-{major}.{minor}"
            for name in _alternatives(names):
                glue = f"v?{number}" if name.endswith("v?") else number
                name = name.removesuffix("v?")
                joined = [f"{name} (?:v|v ?|version |ver ?)?{glue.removeprefix('v?')}"]
                if glue.startswith("v?"):
                    joined += [f"{name}v{number}", f"{name}{number}"]
                for pattern in joined:
                    out += _rule(label, NAMED, pattern)
                    if stem in ("gpl", "lgpl", "agpl", "gfdl"):
                        out += _rule(f"{label}-or-later", NAMED, f"{pattern} {_LATER}")
    for code, words in _CC:
        for version in _CC_VERSIONS:
            label = f"cc-{code}-{version.replace(' ', '.')}"
            out += _rule(label, NAMED, f"cc {code.replace('-', ' ')} {version}")
            out += _rule(label, NOTICE, f"creative commons {words}(?: international| unported| generic)?(?: public)?(?: licen[cs]e)?(?: version)? {version}")
            out += _rule(label, NOTICE, f"creativecommons org licenses {code.replace('-', ' ')} {version}")
        out += _rule(f"cc-{code}", BARE, f"creative commons {words}")
    for label, priority, pattern in _HAND:
        out += _rule(label, priority, pattern)
    return out


def spdx_label(words: str) -> str:
    """"gpl 3 0 or later" to "gpl-3.0-or-later"."""
    out = ""
    previous = ""
    for w in words.split(" "):
        out += ("." if w[0].isdigit() and previous.isdigit() else "-") + w if out else w
        previous = w
    return out
