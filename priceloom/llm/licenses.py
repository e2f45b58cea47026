"""License scans: ordered signature rules behind a keyword prefilter, overlaps resolved by priority and containment."""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass
from functools import lru_cache, partial

from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from .arrow import lower_az, map_texts
from .notices import NOTICES

#: Words of license texts: letters and digits of ASCII, and all beyond ASCII.
TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

#: The phrases that every scan looks for, and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: License families as (label, names in words, versions; "" for none).
FAMILIES = (
    ("agpl", ("gnu affero general public license", "affero general public license", "gnu agpl", "agpl"), ("1", "3")),
    ("lgpl", ("gnu lesser general public license", "gnu library general public license", "lesser general public license", "gnu lgpl", "lgpl"), ("2", "2 1", "3")),
    ("gpl", ("gnu general public license", "gnu gpl", "general public license", "gpl"), ("1", "2", "3")),
    ("gfdl", ("gnu free documentation license", "gfdl"), ("1 1", "1 2", "1 3")),
    ("apache", ("apache license", "apache software license", "apache"), ("1", "1 1", "2", "2 0")),
    ("mpl", ("mozilla public license", "mpl"), ("1 0", "1 1", "2 0")),
    ("epl", ("eclipse public license", "epl"), ("1 0", "2 0")),
    ("cddl", ("common development and distribution license", "cddl"), ("1 0", "1 1")),
    ("cpl", ("common public license", "cpl"), ("1 0",)),
    ("eupl", ("european union public licence", "european union public license", "eupl"), ("1 0", "1 1", "1 2")),
    ("osl", ("open software license",), ("1 0", "2 0", "2 1", "3 0")),
    ("afl", ("academic free license",), ("1 1", "2 0", "2 1", "3 0")),
    ("artistic", ("artistic license", "perl artistic license"), ("1 0", "2 0")),
    ("bsl", ("boost software license",), ("1 0",)),
    ("lppl", ("latex project public license", "lppl"), ("1 0", "1 2", "1 3")),
    ("zpl", ("zope public license",), ("1 1", "2 0", "2 1")),
    ("php", ("php license",), ("3 0", "3 01")),
    ("ofl", ("sil open font license", "open font license"), ("1 0", "1 1")),
    ("ms-pl", ("microsoft public license", "ms pl"), ("",)),
    ("ms-rl", ("microsoft reciprocal license", "ms rl"), ("",)),
    ("isc", ("isc license",), ("",)),
    ("zlib", ("zlib license", "zlib libpng license"), ("",)),
    ("unlicense", ("the unlicense", "released under the unlicense"), ("",)),
    ("wtfpl", ("do what the fuck you want to public license", "wtfpl"), ("",)),
    ("mit", ("mit license", "expat license", "x11 license", "mit expat license"), ("",)),
    ("bsd", ("bsd license", "berkeley software distribution license"), ("",)),
    ("bsd-2-clause", ("bsd 2 clause", "simplified bsd license", "freebsd license", "two clause bsd"), ("",)),
    ("bsd-3-clause", ("bsd 3 clause", "new bsd license", "modified bsd license", "three clause bsd"), ("",)),
    ("bsd-4-clause", ("bsd 4 clause", "original bsd license", "four clause bsd"), ("",)),
    ("cc0", ("cc0", "creative commons zero", "cc zero"), ("", "1 0")),
    ("odbl", ("open database license", "odbl"), ("", "1 0")),
    ("public-domain", ("dedicated to the public domain", "released into the public domain", "placed in the public domain"), ("",)),
)

#: Parts of Creative Commons names as (label, words).
CC_TERMS = (
    ("cc-by-nc-nd", ("by nc nd", "attribution noncommercial noderivatives", "attribution noncommercial noderivs", "attribution non commercial no derivatives")),
    ("cc-by-nc-sa", ("by nc sa", "attribution noncommercial sharealike", "attribution non commercial share alike")),
    ("cc-by-nc", ("by nc", "attribution noncommercial", "attribution non commercial")),
    ("cc-by-nd", ("by nd", "attribution noderivatives", "attribution noderivs", "attribution no derivatives")),
    ("cc-by-sa", ("by sa", "attribution sharealike", "attribution share alike")),
    ("cc-by", ("by", "attribution")),
)
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")

#: Sentences of license texts as (label, word that each match holds, pattern over words with single spaces).
SENTENCES = (
    ("mit", "permission", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "mit", r"(?:licensed|released|distributed|available) under the (?:terms of the )?mit"),
    ("mit", "expat", r"(?:licensed|released|distributed|available) under the (?:terms of the )?expat"),
    ("mit", "x11", r"(?:licensed|released|distributed|available) under the (?:terms of the )?x11"),
    ("isc", "permission", r"permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "contributors", r"neither the name of (?:\S+ ){1,12}nor the names of its contributors"),
    ("bsd-4-clause", "advertising", r"all advertising materials mentioning features or use of this software must display"),
    ("zlib", "warranty", r"this software is provided as is without any express or implied warranty in no event will the authors"),
    ("apache", "apache", r"licensed under the apache license"),
    ("gpl", "redistribute", r"(?:this program|this software|it) is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "redistribute", r"redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("bsl", "permission", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("all-rights-reserved", "reserved", r"all rights reserved"),
    ("proprietary", "proprietary", r"proprietary and confidential"),
    ("proprietary", "unauthorized", r"unauthorized copying of this file"),
    ("copyright", "copyright", r"copyright (?:c )?(?:19|20)\d\d"),
    ("apache", "apache", r"you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org"),
    ("apache", "contributor", r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|patent) license"),
    ("mit", "sublicense", r"to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", "substantial", r"the above copyright notice and this permission notice (?:including the next paragraph )?shall be included in all copies or substantial portions of the software"),
    ("mit", "noninfringement", r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("bsd", "redistributions", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "redistributions", r"redistributions in binary form must reproduce the above copyright notice this list of conditions"),
    ("bsd-3-clause", "endorse", r"may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-4-clause", "acknowledgement", r"must display the following acknowledgement this product includes software developed by"),
    ("isc", "author", r"the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("zlib", "misrepresented", r"the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", "altered", r"altered source versions must be plainly marked as such"),
    ("gpl", "foundation", r"as published by the free software foundation either version \d of the license or (?:at your option )?any later version"),
    ("gpl", "merchantability", r"without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details"),
    ("gpl", "gnu", r"you should have received a copy of the gnu general public license along with this program"),
    ("lgpl", "lesser", r"you should have received a copy of the gnu lesser general public license along with this (?:library|program)"),
    ("lgpl", "library", r"this library is free software you can redistribute it and or modify it"),
    ("agpl", "affero", r"you should have received a copy of the gnu affero general public license along with this program"),
    ("agpl", "network", r"your modified version must prominently offer all users interacting with it remotely through a computer network"),
    ("gfdl", "document", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("gfdl", "invariant", r"with no invariant sections no front cover texts and no back cover texts"),
    ("mpl", "mozilla", r"this source code form is subject to the terms of the mozilla public license"),
    ("mpl", "mpl", r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("epl", "eclipse", r"this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("cddl", "distribution", r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("bsl", "boost", r"distributed under the boost software license"),
    ("ms-pl", "governs", r"this license governs use of the accompanying software if you use the software you accept this license"),
    ("artistic", "perl", r"under the same terms as perl itself"),
    ("artistic", "artistic", r"you may distribute under the terms of (?:either the gnu general public license or )?the artistic license"),
    ("ofl", "font", r"this font software is licensed under the sil open font license"),
    ("ofl", "reserved", r"no modified version of the font software may use the reserved font name"),
    ("cc-by", "credit", r"you must give appropriate credit provide a link to the license and indicate if changes were made"),
    ("cc-by-sa", "remix", r"if you remix transform or build upon the material you must distribute your contributions under the same license"),
    ("cc-by-nc", "commercial", r"you may not use the material for commercial purposes"),
    ("cc-by-nd", "modified", r"if you remix transform or build upon the material you may not distribute the modified material"),
    ("cc0", "waived", r"has waived all copyright and related or neighboring rights"),
    ("cc", "creative", r"this work is licensed under a creative commons"),
    ("public-domain", "domain", r"this (?:work|file|software|program|code) is (?:hereby )?(?:in|released (?:in)?to|placed in(?:to)?) the public domain"),
    ("public-domain", "domain", r"the author(?:s)? (?:has|have|hereby)? ?(?:dedicated?|disclaims? copyright)[\w ]{0,60}public domain"),
    ("unlicense", "anyone", r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("wtfpl", "fuck", r"you just do what the fuck you want to"),
    ("beerware", "beer", r"if we meet some day and you think this stuff is worth it you can buy me a beer in return"),
    ("json", "evil", r"the software shall be used for good not evil"),
    ("openssl", "openssl", r"this product includes software developed by the openssl project"),
    ("php", "php", r"this product includes php software freely available from"),
    ("python", "psf", r"psf hereby grants licensee a nonexclusive royalty free world wide license"),
    ("ruby", "ruby", r"ruby is copyrighted free software by yukihiro matsumoto"),
    ("curl", "appear", r"permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("commercial", "commercial", r"for (?:personal and )?non commercial use only"),
    ("evaluation", "evaluation", r"for evaluation purposes only"),
    ("no-redistribution", "without", r"may not (?:be )?(?:copied reproduced or )?redistributed? (?:in any form )?without (?:the )?(?:prior )?(?:express )?(?:written )?(?:permission|consent)"),
    ("trademark", "trademark", r"is a (?:registered )?trademark of"),
    ("trademark", "trademarks", r"are (?:registered )?trademarks of"),
    ("patent", "patents", r"(?:protected by|covered by) (?:one or more )?(?:us |u s )?patents"),
    ("license-file", "see", r"see (?:the )?(?:accompanying )?licen[cs]e(?: txt| md)?(?: file)? for (?:license |licensing )?(?:details|information|terms)"),
    ("license-file", "license", r"found in the license file(?: in the root directory of this source tree)?"),
    ("dual", "dual", r"(?:is )?dual licensed under"),
)

#: Identifiers of the public license list that follow "SPDX-License-Identifier:".
SPDX = """
0BSD AFL-2.1 AFL-3.0 AGPL-1.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.0 Apache-1.1 Apache-2.0 APSL-2.0 Artistic-1.0 Artistic-2.0 Beerware BSD-1-Clause
BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Clear BSD-4-Clause BSL-1.0 BUSL-1.1 CAL-1.0 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0
CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 CDDL-1.1 CECILL-2.1 CPL-1.0 curl ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2
GFDL-1.2-only GFDL-1.3-only GFDL-1.3-or-later GPL-1.0-only GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later HPND ISC JSON LGPL-2.0-only
LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later LPL-1.02 LPPL-1.3c MIT MIT-0 MPL-1.1 MPL-2.0 MS-PL MS-RL MulanPSL-2.0 NCSA ODbL-1.0 OFL-1.1
OpenSSL OSL-3.0 PHP-3.01 PostgreSQL Python-2.0 QPL-1.0 Ruby SGI-B-2.0 SSPL-1.0 Sleepycat Unicode-3.0 Unlicense UPL-1.0 Vim W3C WTFPL X11 Zlib ZPL-2.1
""".split()


@dataclass(frozen=True)
class Rule:
    priority: int  # lower wins
    label: str
    pattern: str
    keyword: str  # a word that each match holds
    weight: float


def _keyword(words: str) -> str:
    """The word of a phrase that prefilters it: its longest one."""
    return max(words.split(), key=len)


@lru_cache(1)
def rules() -> tuple[Rule, ...]:
    """All signature rules in order: base phrases, names with versions, names, identifiers, sentences and notices."""
    out = [Rule(0, label, re.escape(phrase).replace(r"\ ", " "), _keyword(phrase), 1.0) for phrase, label in BASE]
    for label, names, versions in FAMILIES:
        for name in names:
            for v in versions:
                full = f"{label}-{v.replace(' ', '.')}".removesuffix(".0") if v else label
                if v:
                    out.append(Rule(1, full, rf"{name} (?:v |version |ver )?v?{v}(?: or (?:any )?later(?: version)?)?", _keyword(name), 0.95))
                    short = v.replace(" ", "")
                    if short != v:
                        out.append(Rule(1, full, rf"{name} (?:v |version )?v?{short}", _keyword(name), 0.9))
            out.append(Rule(3, label, name, _keyword(name), 0.7))
    for label, terms in CC_TERMS:
        for term in terms:
            for head, key in (("cc", "cc"), ("creative commons", "creative")):
                for v in CC_VERSIONS:
                    out.append(Rule(1, f"{label}-{v.replace(' ', '.')}", rf"{head} {term} (?:license |international |unported |version |v )*v?{v}", key, 0.95))
                out.append(Rule(2, label, rf"{head} {term}(?: license)?", key, 0.8))
    for name in SPDX:
        label = re.sub("-(only|or-later)$", "", name).lower().removesuffix(".0")
        out.append(Rule(1, label, "spdx license identifier " + " ".join(TOKEN.findall(name.lower())), "spdx", 0.98))
    out += [Rule(4, label, pattern, keyword, 0.6) for label, keyword, pattern in (*SENTENCES, *NOTICES)]
    return tuple(out)


@lru_cache(1)
def _compiled() -> dict[str, list]:
    """The method's rules by keyword, as patterns over words with a space on both sides."""
    by: dict[str, list[tuple[int, Rule, re.Pattern]]] = {rule.keyword: [] for rule in rules()}
    for n, rule in enumerate(rules()):
        if rule.priority:
            by[rule.keyword].append((n, rule, re.compile(rf"(?<= )(?:{rule.pattern})(?= )")))
    return by


def detect(padded: str, keywords: set[str]) -> list[tuple[int, int, int, str, float]]:
    """(start, end, priority, label, weight) in characters of the padded words, after suppression.

    Sorted by priority, then by length, then by place, then by order of rules, each match stays unless it lies inside one that
    stays already. So a longer, more exact signature hides the names inside it.
    """
    by = _compiled()
    found = []
    for word in keywords:
        for n, rule, rx in by[word]:
            found += [(rule.priority, m.start() - m.end(), m.start(), n, m.end(), rule) for m in rx.finditer(padded)]
    found.sort(key=lambda x: x[:4])
    starts: list[int] = []  # kept intervals, none inside another: their ends rise with their starts
    ends: list[int] = []
    kept = []
    for priority, _, start, _, end, rule in found:
        at = bisect_right(starts, start)
        if at and ends[at - 1] >= end:
            continue
        kept.append((start, end, priority, rule.label, rule.weight))
        to = at
        while to < len(ends) and ends[to] <= end:  # what this one holds stays found, but hides nothing more than this one does
            to += 1
        starts[at:to], ends[at:to] = [start], [end]
    return sorted(kept)


def _scanner():
    by = _compiled()
    base = [(f" {phrase} ", label) for phrase, label in BASE]

    def scan(texts: list) -> list:
        rows = []
        for text in texts:
            low = lower_az(text or "")
            words = TOKEN.findall(low)
            keywords = by.keys() & words
            if not keywords:
                rows.append((len(words), 0, None, None, [], [], 0.0, []))
                continue
            padded = f" {' '.join(words)} "
            places, labels = [], set()
            for phrase, label in base:
                at = padded.find(phrase)
                while at >= 0:
                    places.append(at)
                    labels.add(label)
                    at = padded.find(phrase, at + 1)
            found = detect(padded, keywords)
            index = _WordIndex(padded)
            spans = [{"first": index.of(a), "last": index.of(b - 1), "priority": p, "label": x} for a, b, p, x, _ in found]
            miss = 1.0
            for weight in {x: w for _, _, _, x, w in sorted(found, key=lambda f: f[4])}.values():
                miss *= 1.0 - weight
            score = 1.0 if labels else 1.0 - miss
            rows.append((len(words), len(places), index.of(min(places) + 1) if places else None, index.of(max(places) + 1) if places else None, sorted(labels), sorted(labels | {x for _, _, _, x, _ in found}), score, spans))
        return list(zip(*rows)) or [[]] * 8

    return scan


class _WordIndex:
    """Number of the word that holds a character of the padded words."""

    def __init__(self, padded: str):
        self.starts = [m.end() for m in re.finditer(" ", padded)]

    def of(self, at: int) -> int:
        return bisect_right(self.starts, at) - 1


def scan_licenses(df: DataFrame, text: str = "text", keys: tuple = ("doc_id",)) -> DataFrame:
    """Licenses named or quoted in each text.

    n_words; n_base, first_word, last_word: places of the base phrases, all of them, and their smallest and largest start (null
    without any); base_labels and found_labels (base ones included): sorted arrays; score: 1 with a base phrase, else the chance
    that some detection is right by the rules' weights; detections: spans in words that stay after suppression. Equal labels at
    several places count once. Null and empty texts have 0 words and no labels. Repeated rows each give a row, an empty table
    gives none; further columns are left out.
    """
    span = StructType([StructField("first", IntegerType()), StructField("last", IntegerType()), StructField("priority", IntegerType()), StructField("label", StringType())])
    fields = [StructField("n_words", LongType()), StructField("n_base", LongType()), StructField("first_word", LongType()), StructField("last_word", LongType()), StructField("base_labels", ArrayType(StringType())), StructField("found_labels", ArrayType(StringType())), StructField("score", DoubleType()), StructField("detections", ArrayType(span))]
    return map_texts(df, partial(_scanner), fields, keys, text)
