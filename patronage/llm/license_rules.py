"""Signature rules for licence texts, notices and references, in order.

A rule is a regular expression over lower-cased text in which runs of white space and comment marks
are one space. The tables below are written by hand; each licence gets one rule for each of its
names, and one for each kind of reference to it (identifier tag, URL, "licensed under"). A rule's
keyword stands in every text that the rule fits, so texts without it are not searched. A licence's
keyword is taken for those of its patterns that cannot fit without it; others get a literal of their own.
"""

from __future__ import annotations

import re
from re import _constants as op
from re import _parser
from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    keyword: str  # empty: every text is searched
    pattern: re.Pattern
    priority: int  # of overlapping detections the smaller number stays
    weight: float  # how sure the label is


#: label: keyword of most names; names; identifiers; places in URLs
LICENSES: dict[str, tuple[str, tuple[str, ...], tuple[str, ...], tuple[str, ...]]] = {
    "0bsd": ("bsd", (r"(bsd )?zero[- ]clause bsd( license)?", r"0[- ]clause bsd"), ("0bsd",), (r"licenses/0bsd",)),
    "afl": ("academic", (r"academic free license( v(ersion)?\.? ?[123](\.[0-2])?)?",), ("afl-1.1", "afl-2.1", "afl-3.0"), (r"licenses/afl-3\.0",)),
    "agpl": ("affero", (r"(gnu )?affero general public license(,? v(ersion)?\.? ?3)?", r"gnu agpl ?v?3"), ("agpl-3.0", "agpl-3.0-only", "agpl-3.0-or-later"), (r"gnu\.org/licenses/agpl",)),
    "apache": ("apache", (r"apache (software )?license,? (v(ersion)? ?)?[12](\.[01])?", r"apache(-| )2(\.0)? licen[sc]ed?", r"apache (software )?license"), ("apache-1.1", "apache-2.0"), (r"apache\.org/licenses/license-2\.0", r"apache\.org/licenses")),
    "artistic": ("artistic", (r"artistic license,? (v(ersion)? ?)?[12](\.0)?", r"perl artistic license", r"artistic license"), ("artistic-1.0", "artistic-2.0"), (r"licenses/artistic-license",)),
    "beerware": ("beer", (r"the beer-?ware license", r"you can buy me a beer in return"), ("beerware",), ()),
    "bsd": ("bsd", (r"(new|modified|revised|simplified|original) bsd license", r"(2|3|4|two|three|four)[- ]clause bsd( license)?", r"bsd[- ](2|3|4)[- ]clause", r"bsd[- ]style licen[sc]ed?", r"bsd license"), ("bsd-2-clause", "bsd-3-clause", "bsd-4-clause"), (r"opensource\.org/licenses/bsd-[234]-clause", r"freebsd\.org/copyright")),
    "bsl": ("boost", (r"boost software license( -)?,? (v(ersion)? ?)?1\.0", r"boost software license"), ("bsl-1.0",), (r"boost\.org/license_1_0",)),
    "busl": ("business source", (r"business source license( 1\.1)?",), ("busl-1.1",), (r"mariadb\.com/bsl11",)),
    "cc-by": ("creative commons", (r"creative commons attribution( [1-4]\.0)?( international| unported)?( public)? license", r"creative commons attribution"), ("cc-by-2.0", "cc-by-3.0", "cc-by-4.0"), (r"creativecommons\.org/licenses/by/",)),
    "cc-by-nc": ("noncommercial", (r"creative commons attribution[- ]noncommercial", r"attribution[- ]noncommercial [1-4]\.0"), ("cc-by-nc-3.0", "cc-by-nc-4.0"), (r"creativecommons\.org/licenses/by-nc/",)),
    "cc-by-nc-nd": ("noderiv", (r"attribution[- ]noncommercial[- ]noderiv(ative)?s?",), ("cc-by-nc-nd-3.0", "cc-by-nc-nd-4.0"), (r"creativecommons\.org/licenses/by-nc-nd/",)),
    "cc-by-nc-sa": ("sharealike", (r"attribution[- ]noncommercial[- ]sharealike",), ("cc-by-nc-sa-3.0", "cc-by-nc-sa-4.0"), (r"creativecommons\.org/licenses/by-nc-sa/",)),
    "cc-by-nd": ("noderiv", (r"creative commons attribution[- ]noderiv(ative)?s?",), ("cc-by-nd-3.0", "cc-by-nd-4.0"), (r"creativecommons\.org/licenses/by-nd/",)),
    "cc-by-sa": ("sharealike", (r"creative commons attribution[- ]sharealike", r"attribution[- ]sharealike [1-4]\.0"), ("cc-by-sa-2.0", "cc-by-sa-3.0", "cc-by-sa-4.0"), (r"creativecommons\.org/licenses/by-sa/",)),
    "cc0": ("cc0", (r"cc0 1\.0( universal)?", r"cc0 public domain dedication", r"\bcc0\b"), ("cc0-1.0",), (r"creativecommons\.org/publicdomain/zero",)),
    "cddl": ("common development", (r"common development and distribution license( \(?cddl\)?)?(,? v(ersion)? ?1\.[01])?",), ("cddl-1.0", "cddl-1.1"), (r"licenses/cddl",)),
    "cecill": ("cecill", (r"cecill(-[bc2])?( free software)? license", r"licence cecill(-[bc])?"), ("cecill-2.1", "cecill-b", "cecill-c"), (r"cecill\.info",)),
    "cpal": ("common public attribution", (r"common public attribution license( v(ersion)? ?1\.0)?",), ("cpal-1.0",), (r"licenses/cpal_1\.0",)),
    "cpl": ("common public", (r"common public license( v(ersion)? ?1\.0)?",), ("cpl-1.0",), (r"licenses/cpl1\.0",)),
    "ecl": ("educational community", (r"educational community license,?( v(ersion)? ?[12]\.0)?",), ("ecl-2.0",), (r"licenses/ecl-2\.0",)),
    "efl": ("eiffel", (r"eiffel forum license,?( v(ersion)? ?2)?",), ("efl-2.0",), ()),
    "elastic": ("elastic", (r"elastic license( v?2(\.0)?)?",), ("elastic-2.0",), (r"elastic\.co/licensing/elastic-license",)),
    "epl": ("eclipse", (r"eclipse public license( -)?,? (v(ersion)?\.? ?)?[12]\.0", r"eclipse public license"), ("epl-1.0", "epl-2.0"), (r"eclipse\.org/legal/epl", r"licenses/epl")),
    "edl": ("eclipse", (r"eclipse distribution license( -)?,?( v(ersion)?\.? ?1\.0)?",), (), (r"eclipse\.org/org/documents/edl",)),
    "eupl": ("european union", (r"european union public licen[cs]e,?( v(ersion)?\.? ?1\.[012])?",), ("eupl-1.1", "eupl-1.2"), (r"joinup\.ec\.europa\.eu/.{0,40}eupl",)),
    "fair": ("fair license", (r"the fair license",), (), (r"licenses/fair",)),
    "ftl": ("freetype", (r"the freetype project license", r"freetype license"), ("ftl",), (r"freetype\.org/license",)),
    "gfdl": ("documentation license", (r"gnu free documentation license,?( v(ersion)? ?1\.[123])?",), ("gfdl-1.2", "gfdl-1.3"), (r"gnu\.org/licenses/fdl", r"gnu\.org/copyleft/fdl")),
    "gpl": ("general public", (r"gnu general public license,? (as published by the free software foundation|v(ersion)?\.? ?[123](\.0)?)", r"gnu general public license", r"under the terms of the (gnu )?gpl( ?v?[23])?"), ("gpl-2.0", "gpl-2.0-only", "gpl-2.0-or-later", "gpl-3.0", "gpl-3.0-only", "gpl-3.0-or-later"), (r"gnu\.org/licenses/gpl", r"gnu\.org/copyleft/gpl")),
    "hpnd": ("historical permission", (r"historical permission notice and disclaimer",), ("hpnd",), (r"licenses/hpnd",)),
    "icu": ("icu", (r"\bicu license( -)? icu 1\.8\.1 and later", r"\bicu license\b"), ("icu",), ()),
    "ijg": ("independent jpeg", (r"independent jpeg group('s)? (free )?(license|software)",), ("ijg",), ()),
    "ipl": ("ibm public", (r"ibm public license( v(ersion)? ?1\.0)?",), ("ipl-1.0",), (r"licenses/ibmpl",)),
    "isc": ("isc", (r"\bisc license\b", r"licensed under the isc\b", r"internet (systems|software) consortium license"), ("isc",), (r"opensource\.org/licenses/isc",)),
    "json": ("good, not evil", (r"the software shall be used for good, not evil",), ("json",), (r"json\.org/license",)),
    "lgpl": ("general public", (r"gnu (lesser|library) general public license,?( v(ersion)?\.? ?[23](\.[01])?)?", r"(lesser|library) gpl\b"), ("lgpl-2.0", "lgpl-2.1", "lgpl-2.1-only", "lgpl-2.1-or-later", "lgpl-3.0", "lgpl-3.0-or-later"), (r"gnu\.org/licenses/lgpl", r"gnu\.org/copyleft/lesser")),
    "libpng": ("libpng", (r"libpng license( v(ersion)? ?2)?",), ("libpng", "libpng-2.0"), (r"libpng\.org/pub/png/src/libpng-license",)),
    "lppl": ("latex project", (r"latex project public license,?( v(ersion)? ?1\.[0-3][abc]?)?",), ("lppl-1.3a", "lppl-1.3c"), (r"latex-project\.org/lppl",)),
    "lucent": ("lucent", (r"lucent public license,?( v(ersion)? ?1\.02)?",), ("lpl-1.02",), ()),
    "mit": ("mit", (r"\b(the )?(mit|expat) (software )?licen[sc]e\b", r"\bmit[- ]style licen[sc]ed?", r"\bmit[- ]licensed\b", r"licensed under (the )?mit\b"), ("mit", "mit-0"), (r"opensource\.org/licenses/mit", r"mit-license\.org")),
    "mpl": ("mozilla", (r"mozilla public license,? (v(ersion)?\.? ?)?[12]\.[01]", r"mozilla public license"), ("mpl-1.1", "mpl-2.0"), (r"mozilla\.org/mpl",)),
    "ms-pl": ("microsoft", (r"microsoft public license( \(ms-pl\))?",), ("ms-pl",), (r"licenses/ms-pl",)),
    "ms-rl": ("microsoft", (r"microsoft reciprocal license( \(ms-rl\))?",), ("ms-rl",), (r"licenses/ms-rl",)),
    "mulan": ("mulan", (r"mulan permissive software license,?( v(ersion)? ?[12])?", r"\bmulan psl ?v?[12]"), ("mulanpsl-1.0", "mulanpsl-2.0"), (r"license\.coscl\.org\.cn/mulanpsl",)),
    "ncsa": ("ncsa", (r"university of illinois/?(ncsa)? open source license", r"\bncsa open source license"), ("ncsa",), (r"licenses/(uoi-)?ncsa",)),
    "nasa": ("nasa", (r"nasa open source agreement( v(ersion)? ?1\.3)?",), ("nasa-1.3",), ()),
    "nposl": ("non-profit open", (r"non-profit open software license( 3\.0)?",), ("nposl-3.0",), ()),
    "odbl": ("open database", (r"open (data commons )?(open )?database license( \(?odbl\)?)?( v?1\.0)?",), ("odbl-1.0",), (r"opendatacommons\.org/licenses/odbl",)),
    "odc-by": ("open data commons", (r"open data commons attribution license( v?1\.0)?",), ("odc-by-1.0",), (r"opendatacommons\.org/licenses/by",)),
    "ofl": ("open font", (r"sil open font license,?( v(ersion)? ?1\.[01])?", r"open font license"), ("ofl-1.0", "ofl-1.1"), (r"scripts\.sil\.org/ofl", r"openfontlicense\.org")),
    "openldap": ("openldap", (r"openldap public license( v(ersion)? ?2\.[78])?",), ("oldap-2.8",), (r"openldap\.org/software/release/license",)),
    "openssl": ("openssl", (r"openssl license", r"developed by the openssl project for use in the openssl toolkit"), ("openssl",), (r"openssl\.org/source/license",)),
    "osl": ("open software", (r"\bopen software license( v(ersion)?\.? ?[123]\.[01])?",), ("osl-2.1", "osl-3.0"), (r"licenses/osl-3\.0",)),
    "php": ("php", (r"\bphp license,?( v(ersion)? ?3\.0[01]?)?",), ("php-3.0", "php-3.01"), (r"php\.net/license",)),
    "postgresql": ("postgresql", (r"postgresql licen[cs]e",), ("postgresql",), (r"postgresql\.org/about/licence",)),
    "psf": ("python", (r"python software foundation license( v(ersion)? ?2)?", r"\bpsf license( agreement)?"), ("psf-2.0", "python-2.0"), (r"docs\.python\.org/.{0,12}license",)),
    "public-domain": ("public domain", (r"(released|placed|dedicated) (in)?to the public domain", r"\bis in the public domain"), (), ()),
    "qpl": ("q public", (r"\bthe q public license( v(ersion)? ?1\.0)?",), ("qpl-1.0",), ()),
    "rpl": ("reciprocal", (r"reciprocal public license,?( v(ersion)? ?1\.[15])?",), ("rpl-1.5",), ()),
    "ruby": ("ruby", (r"\bruby'?s? license\b", r"same terms as ruby itself"), ("ruby",), (r"ruby-lang\.org/.{0,12}license",)),
    "sleepycat": ("sleepycat", (r"sleepycat (public )?license",), ("sleepycat",), (r"licenses/sleepycat",)),
    "sspl": ("server side", (r"server side public license,?( v(ersion)? ?1)?",), ("sspl-1.0",), (r"mongodb\.com/licensing/server-side-public-license",)),
    "unicode": ("unicode", (r"unicode(, inc\.)? license agreement( -)? data files and software", r"unicode license v3"), ("unicode-3.0", "unicode-dfs-2016"), (r"unicode\.org/(copyright|license)",)),
    "unlicense": ("unencumbered", (r"free and unencumbered software released into the public domain",), ("unlicense",), (r"unlicense\.org",)),
    "upl": ("universal permissive", (r"universal permissive license,?( v(ersion)? ?1\.0)?",), ("upl-1.0",), (r"oss\.oracle\.com/licenses/upl",)),
    "vim": ("vim", (r"\bvim license\b",), ("vim",), ()),
    "w3c": ("w3c", (r"\bw3c software( and document)? (notice and )?license",), ("w3c", "w3c-20150513"), (r"w3\.org/consortium/legal",)),
    "watcom": ("watcom", (r"sybase open watcom public license( v(ersion)? ?1\.0)?",), ("watcom-1.0",), ()),
    "wtfpl": ("do what the", (r"do what the f\S{0,5} you want to public license", r"\bwtfpl\b"), ("wtfpl",), (r"wtfpl\.net",)),
    "x11": ("x11", (r"\bx11 license\b", r"\bx consortium license\b"), ("x11",), ()),
    "zlib": ("zlib", (r"\bzlib(/libpng)? license\b",), ("zlib",), (r"zlib\.net/zlib_license",)),
    "zpl": ("zope", (r"zope public license( \(zpl\))?,?( v(ersion)? ?2\.[01])?",), ("zpl-2.0", "zpl-2.1"), ()),
}

#: label, keyword of most of its texts, clause: wording of the licences themselves
CLAUSES: tuple[tuple[str, str, str], ...] = (
    ("mit", "permission is hereby granted", r"permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("mit", "above copyright notice and this permission notice", r"the above copyright notice and this permission notice shall be included"),
    ("bsd", "redistribution and use in source", r"redistribution and use in source and binary forms, with or without modification"),
    ("bsd", "redistributions of source code", r"redistributions of source code must retain the above copyright notice"),
    ("bsd", "redistributions in binary form", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd", "neither the name", r"neither the name of .{1,80} nor the names of its contributors"),
    ("isc", "permission to use, copy", r"permission to use, copy, modify,? and/?(or)? distribute this software for any purpose"),
    ("apache", "licensed under the apache", r"licensed under the apache license"),
    ("apache", "you may not use this file except", r"you may not use this file except in compliance with the license"),
    ("gpl", "free software; you can", r"is free software[;:] you can redistribute it and/or modify"),
    ("gpl", "you should have received a copy", r"you should have received a copy of the gnu general public license"),
    ("lgpl", "you should have received a copy", r"you should have received a copy of the gnu (lesser|library) general public license"),
    ("agpl", "you should have received a copy", r"you should have received a copy of the gnu affero general public license"),
    ("mpl", "subject to the terms of the mozilla", r"this source code form is subject to the terms of the mozilla public license"),
    ("zlib", "provided 'as-is'", r"this software is provided 'as-is', without any express or implied warranty"),
    ("bsl", "obtaining a copy of the software and accompanying", r"any person or organization obtaining a copy of the software and accompanying documentation"),
    ("proprietary", "all rights reserved", r"\ball rights reserved\b"),
    ("proprietary", "confidential", r"\b(proprietary and confidential|confidential and proprietary)\b"),
    ("proprietary", "unauthorized copying", r"unauthorized copying of this file,? via any medium,? is strictly prohibited"),
    ("no-warranty", "without warranty", r"\bwithout warranty of any kind\b"),
    ("no-warranty", "without any warranty", r"\bwithout any warranty\b"),
)


def _runs(items) -> tuple[list[str], list[list]]:
    """Literal strings that stand in every match of a parsed pattern, and the branches that every match goes through."""
    runs, branches = [""], []

    def walk(items) -> None:
        for kind, value in items:
            if kind is op.LITERAL:
                runs[-1] += chr(value)
            elif kind is op.SUBPATTERN:
                walk(value[3])
            elif kind is op.AT:
                continue
            else:
                runs.append("")
                if kind is op.BRANCH:
                    branches.append(value[1])
                elif kind is op.MAX_REPEAT and value[0] > 0:
                    walk(value[2])
                    runs.append("")

    walk(items)
    return runs, branches


def _needs(items, keyword: str) -> bool:
    """Whether the keyword stands in every match of a parsed pattern."""
    runs, branches = _runs(items)
    return any(keyword in run for run in runs) or any(all(_needs(x, keyword) for x in branch) for branch in branches)


def keyword_of(pattern: str, wanted: str = "") -> str:
    """The wanted keyword if no match is without it, else the longest literal that stands in every match ('' if none does)."""
    items = _parser.parse(pattern)
    return wanted if wanted and _needs(items, wanted) else max(_runs(items)[0], key=len)


def rules() -> list[Rule]:
    """All rules in order: identifier tags, URLs, clauses, names; of names, the more specific licences come first."""
    found = []

    def add(label: str, keyword: str, pattern: str, priority: int, weight: float) -> None:
        found.append(Rule(label, keyword_of(pattern, keyword), re.compile(pattern), priority, weight))

    for label, (keyword, names, tags, urls) in LICENSES.items():
        for tag in tags:
            add(label, tag, rf"spdx-license-identifier: ?\(?{re.escape(tag)}(?![\w.-])", 0, 1.0)
            add(label, tag, rf"\blicen[sc]e\W{{1,4}}{re.escape(tag)}(?![\w.-])", 1, 0.9)
        for url in urls:
            add(label, keyword_of(url), url, 2, 0.95)
        for name in names:
            own = keyword_of(name, keyword)
            # the longer a name, the more specific: "affero general public license" before "general public license"
            add(label, own, rf"\b(licen[sc]ed|distributed|released|available|covered) (under|by) (the )?(terms of the )?({name})", 4, 0.9)
            add(label, own, name, 5, 0.8)
    for label, keyword, clause in CLAUSES:
        add(label, keyword, clause, 3, 0.7 if label in ("proprietary", "no-warranty") else 0.9)
    return sorted(found, key=lambda r: (r.priority, r.label))
