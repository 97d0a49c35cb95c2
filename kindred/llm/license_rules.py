"""The signatures of the license scan.

Each license has hand-written patterns: its title in running text, its identifiers in tags, its
address, and for the best known ones a sentence of its text. Each of these families has a priority
and a confidence. In a pattern a blank stands for anything between two words, and ``version`` for the
ways to write that a version follows. Identifiers and addresses are fixed values.
"""

from __future__ import annotations

import re
from typing import NamedTuple

EDGE = rb"0-9a-z\x80-\xff"
GAP = rb"(?:[^" + EDGE + rb"]+)"
VERSION = rb"[^" + EDGE + rb"]*(?:version|ver|v)[^" + EDGE + rb"]*"

#: label, words that any of its patterns needs, title, identifiers, address
LICENSES = [
    ("agpl-1.0", "affero", "affero general public license version 1(?:\\.0)?", "agpl-1\\.0(?:-only|-or-later)?", "www\\.affero\\.org/oagpl\\.html"),
    ("agpl-3.0", "affero|agpl", "(?:gnu )?affero general public license(?: version 3)?", "agpl-3\\.0(?:-only|-or-later|\\+)?", "gnu\\.org/licenses/agpl(?:-3\\.0)?"),
    ("gpl-1.0", "general public|gpl", "(?:gnu )?general public license version 1(?:\\.0)?", "gpl-1\\.0(?:-only|-or-later|\\+)?", "gnu\\.org/licenses/(?:old-licenses/)?gpl-1\\.0"),
    ("gpl-2.0", "general public|gpl", "(?:gnu )?general public license version 2(?:\\.0)?", "gpl-2\\.0(?:-only|-or-later|\\+)?", "gnu\\.org/licenses/(?:old-licenses/)?gpl-2\\.0"),
    ("gpl-3.0", "general public|gpl", "(?:gnu )?general public license version 3(?:\\.0)?", "gpl-3\\.0(?:-only|-or-later|\\+)?", "gnu\\.org/licenses/gpl(?:-3\\.0)?(?:\\.html|\\.txt)"),
    ("lgpl-2.0", "lgpl|library general|lesser", "(?:gnu )?library general public license(?: version 2(?:\\.0)?)?", "lgpl-2\\.0(?:-only|-or-later|\\+)?", "gnu\\.org/licenses/(?:old-licenses/)?lgpl-2\\.0"),
    ("lgpl-2.1", "lgpl|lesser", "(?:gnu )?lesser general public license version 2\\.1", "lgpl-2\\.1(?:-only|-or-later|\\+)?", "gnu\\.org/licenses/(?:old-licenses/)?lgpl-2\\.1"),
    ("lgpl-3.0", "lgpl|lesser", "(?:gnu )?lesser general public license(?: version 3(?:\\.0)?)?", "lgpl-3\\.0(?:-only|-or-later|\\+)?", "gnu\\.org/licenses/lgpl(?:-3\\.0)?"),
    ("gfdl-1.3", "free documentation|gfdl", "(?:gnu )?free documentation license(?: version 1\\.[123])?", "gfdl-1\\.[123](?:-only|-or-later)?", "gnu\\.org/licenses/fdl"),
    ("apache-1.1", "apache", "apache (?:software )?license version 1\\.[01]", "apache-1\\.[01]", "apache\\.org/licenses/license-1\\.1"),
    ("apache-2.0", "apache", "apache (?:software )?license(?: version)? 2(?:\\.0)?", "apache-2\\.0", "apache\\.org/licenses/license-2\\.0"),
    ("mit", "mit", "(?:the )?mit license", "mit", "opensource\\.org/licenses?/mit"),
    ("mit-0", "mit", "mit no attribution", "mit-0", "github\\.com/aws/mit-0"),
    ("x11", "x11", "x11 license", "x11", "x\\.org/releases/x11r7"),
    ("bsd-1-clause", "bsd", "(?:1|one) clause bsd license", "bsd-1-clause", "opensource\\.org/licenses?/bsd-1-clause"),
    ("bsd-2-clause", "bsd", "(?:(?:2|two) clause|simplified|freebsd) bsd license", "bsd-2-clause(?:-patent|-views)?", "opensource\\.org/licenses?/bsd-2-clause"),
    ("bsd-3-clause", "bsd", "(?:(?:3|three) clause|new|modified|revised) bsd license", "bsd-3-clause(?:-clear|-lbnl)?", "opensource\\.org/licenses?/bsd-3-clause"),
    ("bsd-4-clause", "bsd", "(?:(?:4|four) clause|original|old) bsd license", "bsd-4-clause(?:-uc)?", "spdx\\.org/licenses/bsd-4-clause"),
    ("0bsd", "bsd", "(?:zero clause|0 clause|0bsd) (?:bsd )?license", "0bsd", "opensource\\.org/licenses?/0bsd"),
    ("isc", "isc", "(?:the )?isc license", "isc", "opensource\\.org/licenses?/isc"),
    ("mpl-1.1", "mozilla|mpl", "mozilla public license version 1\\.[01]", "mpl-1\\.[01]", "mozilla\\.org/mpl/(?:mpl-)?1\\.1"),
    ("mpl-2.0", "mozilla|mpl", "mozilla public license(?: version 2(?:\\.0)?)?", "mpl-2\\.0(?:-no-copyleft-exception)?", "mozilla\\.org/mpl/2\\.0"),
    ("epl-1.0", "eclipse|epl", "eclipse public license version 1(?:\\.0)?", "epl-1\\.0", "eclipse\\.org/legal/epl-v10"),
    ("epl-2.0", "eclipse|epl", "eclipse public license(?: version 2(?:\\.0)?)?", "epl-2\\.0", "eclipse\\.org/legal/epl-(?:v20|2\\.0)"),
    ("edl-1.0", "eclipse", "eclipse distribution license(?: version 1(?:\\.0)?)?", "edl-1\\.0", "eclipse\\.org/org/documents/edl-v10"),
    ("cddl-1.0", "cddl|common development", "common development and distribution license(?: version 1\\.0)?", "cddl-1\\.0", "opensource\\.org/licenses?/cddl-1\\.0"),
    ("cddl-1.1", "cddl|common development", "common development and distribution license version 1\\.1", "cddl-1\\.1", "glassfish\\.java\\.net/public/cddl"),
    ("cpl-1.0", "common public", "common public license(?: version 1(?:\\.0)?)?", "cpl-1\\.0", "ibm\\.com/developerworks/library/os-cpl"),
    ("ipl-1.0", "ibm", "ibm public license(?: version 1(?:\\.0)?)?", "ipl-1\\.0", "opensource\\.org/licenses?/ipl-1\\.0"),
    ("artistic-1.0", "artistic", "artistic license(?: version 1(?:\\.0)?)?", "artistic-1\\.0(?:-perl|-cl8)?", "opensource\\.org/licenses?/artistic-license-1\\.0"),
    ("artistic-2.0", "artistic", "artistic license(?: version)? 2(?:\\.0)?", "artistic-2\\.0", "opensource\\.org/licenses?/artistic-license-2\\.0"),
    ("bsl-1.0", "boost|bsl", "boost software license(?: version 1(?:\\.0)?)?", "bsl-1\\.0", "boost\\.org/license_1_0"),
    ("busl-1.1", "business source|busl", "business source license(?: version 1\\.1)?", "busl-1\\.1", "mariadb\\.com/bsl11"),
    ("sspl-1.0", "server side|sspl", "server side public license(?: version 1(?:\\.0)?)?", "sspl-1\\.0", "mongodb\\.com/licensing/server-side-public-license"),
    ("elastic-2.0", "elastic", "elastic license(?: version)? 2(?:\\.0)?", "elastic-2\\.0", "elastic\\.co/licensing/elastic-license"),
    ("unlicense", "unlicense", "(?:the )?unlicense", "unlicense", "unlicense\\.org"),
    ("wtfpl", "wtfpl|what the", "do what the f[a-z*]+ you want to public license", "wtfpl", "wtfpl\\.net"),
    ("zlib", "zlib", "(?:the )?zlib license", "zlib(?:-acknowledgement)?", "zlib\\.net/zlib_license"),
    ("libpng", "libpng", "(?:the )?libpng license", "libpng(?:-2\\.0)?", "libpng\\.org/pub/png/src/libpng-license"),
    ("postgresql", "postgresql", "(?:the )?postgresql license", "postgresql", "postgresql\\.org/about/licen[cs]e"),
    ("python-2.0", "python", "python software foundation license(?: version 2)?", "(?:psf|python)-2\\.0", "docs\\.python\\.org/3/license"),
    ("ruby", "ruby", "ruby license", "ruby", "ruby-lang\\.org/en/about/license"),
    ("php-3.01", "php", "php license(?: version 3\\.0(?:1)?)?", "php-3\\.0(?:1)?", "php\\.net/license"),
    ("openssl", "openssl", "openssl license", "openssl", "openssl\\.org/source/license"),
    ("ncsa", "illinois|ncsa", "(?:university of illinois )?ncsa open source license", "ncsa", "opensource\\.org/licenses?/ncsa"),
    ("vim", "vim", "vim license", "vim", "vimhelp\\.org/uganda"),
    ("ofl-1.1", "sil|ofl", "sil open font license(?: version 1\\.[01])?", "ofl-1\\.[01](?:-rfn|-no-rfn)?", "scripts\\.sil\\.org/ofl"),
    ("lppl-1.3", "latex|lppl", "latex project public license(?: version 1\\.[0-3][ac]?)?", "lppl-1\\.[0-3][ac]?", "latex-project\\.org/lppl"),
    ("eupl-1.2", "european union|eupl", "european union public licen[cs]e(?: version 1\\.[012])?", "eupl-1\\.[012]", "joinup\\.ec\\.europa\\.eu/.{0,40}eupl"),
    ("cecill-2.1", "cecill", "cecill(?: free software)? license(?: version 2\\.[01])?", "cecill-(?:1\\.[01]|2\\.[01]|b|c)", "cecill\\.info/licences"),
    ("ms-pl", "microsoft|ms-pl", "microsoft public license", "ms-pl", "opensource\\.org/licenses?/ms-pl"),
    ("ms-rl", "microsoft|ms-rl", "microsoft reciprocal license", "ms-rl", "opensource\\.org/licenses?/ms-rl"),
    ("osl-3.0", "open software|osl", "open software license(?: version)? [123]\\.[01]", "osl-[123]\\.[01]", "opensource\\.org/licenses?/osl-3\\.0"),
    ("afl-3.0", "academic free|afl", "academic free license(?: version)? [123]\\.[012]", "afl-[123]\\.[012]", "opensource\\.org/licenses?/afl-3\\.0"),
    ("ecl-2.0", "educational community|ecl", "educational community license(?: version)? [12]\\.0", "ecl-[12]\\.0", "opensource\\.org/licenses?/ecl-2\\.0"),
    ("upl-1.0", "universal permissive|upl", "universal permissive license(?: version 1\\.0)?", "upl-1\\.0", "oss\\.oracle\\.com/licenses/upl"),
    ("mulanpsl-2.0", "mulan", "mulan permissive software license(?: version 2)?", "mulanpsl-[12]\\.0", "license\\.coscl\\.org\\.cn/mulanpsl2"),
    ("blueoak-1.0", "blue oak|blueoak", "blue oak model license(?: 1\\.0\\.0)?", "blueoak-1\\.0\\.0", "blueoakcouncil\\.org/license"),
    ("cc0-1.0", "cc0|creative", "(?:cc0|creative commons zero)(?: version)?(?: 1\\.0)?(?: universal)?", "cc0-1\\.0", "creativecommons\\.org/publicdomain/zero"),
    ("cc-pdm-1.0", "public domain mark|creativecommons", "public domain mark 1\\.0", "cc-pddc", "creativecommons\\.org/publicdomain/mark"),
    ("cc-by", "cc|creative", "(?:cc by|creative commons attribution)(?: [1234]\\.0)?(?: international| unported)?", "cc-by-[1234]\\.[05]", "creativecommons\\.org/licenses/by/"),
    ("cc-by-sa", "cc|creative", "(?:cc by sa|creative commons attribution share ?alike)(?: [1234]\\.0)?(?: international| unported)?", "cc-by-sa-[1234]\\.[05]", "creativecommons\\.org/licenses/by-sa/"),
    ("cc-by-nd", "cc|creative", "(?:cc by nd|creative commons attribution no ?derivatives)(?: [1234]\\.0)?(?: international| unported)?", "cc-by-nd-[1234]\\.[05]", "creativecommons\\.org/licenses/by-nd/"),
    ("cc-by-nc", "cc|creative", "(?:cc by nc|creative commons attribution non ?commercial)(?: [1234]\\.0)?(?: international| unported)?", "cc-by-nc-[1234]\\.[05]", "creativecommons\\.org/licenses/by-nc/"),
    ("cc-by-nc-sa", "cc|creative", "(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: [1234]\\.0)?(?: international| unported)?", "cc-by-nc-sa-[1234]\\.[05]", "creativecommons\\.org/licenses/by-nc-sa/"),
    ("cc-by-nc-nd", "cc|creative", "(?:cc by nc nd|creative commons attribution non ?commercial no ?derivatives)(?: [1234]\\.0)?(?: international| unported)?", "cc-by-nc-nd-[1234]\\.[05]", "creativecommons\\.org/licenses/by-nc-nd/"),
    ("odbl-1.0", "odbl|open database|open data commons", "(?:open data commons )?open database license", "odbl-1\\.0", "opendatacommons\\.org/licenses/odbl"),
    ("odc-by-1.0", "odc|open data commons", "open data commons attribution license", "odc-by-1\\.0", "opendatacommons\\.org/licenses/by"),
    ("pddl-1.0", "pddl|public domain dedication|open data commons", "(?:open data commons )?public domain dedication and license", "pddl-1\\.0", "opendatacommons\\.org/licenses/pddl"),
    ("cdla-permissive", "cdla|community data", "community data license agreement permissive(?: version [12]\\.0)?", "cdla-permissive-[12]\\.0", "cdla\\.(?:io|dev)/permissive"),
    ("cdla-sharing", "cdla|community data", "community data license agreement sharing(?: version 1\\.0)?", "cdla-sharing-1\\.0", "cdla\\.(?:io|dev)/sharing"),
    ("openrail", "openrail|rail", "(?:creativeml |bigscience |bigcode )?open ?rail(?: ?[ms]{1,2})?(?: license)?", "(?:bigscience-)?openrail(?:-m)?", "huggingface\\.co/.{0,40}openrail"),
    ("llama-community", "llama", "llama [234](?:\\.[0-9])? community license(?: agreement)?", "llama[234](?:\\.[0-9])?", "llama\\.meta\\.com/.{0,20}license"),
    ("nasa-1.3", "nasa", "nasa open source agreement(?: version)?(?: 1\\.3)?", "nasa-1\\.3", "opensource\\.org/licenses?/nasa1\\.3"),
    ("ogl-uk-3.0", "open government|ogl", "open government licen[cs]e(?: version)?(?: [123]\\.0)?", "ogl-uk-[123]\\.0", "nationalarchives\\.gov\\.uk/doc/open-government-licence"),
    ("etalab-2.0", "etalab|licence ouverte", "(?:licence ouverte|open licence)(?: 2\\.0)?", "etalab-2\\.0", "etalab\\.gouv\\.fr/licence-ouverte"),
    ("json", "json", "json license", "json", "json\\.org/license"),
    ("beerware", "beer", "beer ?ware license", "beerware", "people\\.freebsd\\.org/~phk"),
    ("hpnd", "historical permission", "historical permission notice and disclaimer", "hpnd(?:-sell-variant)?", "opensource\\.org/licenses?/hpnd"),
    ("w3c", "w3c", "w3c software (?:notice and |and document )?license", "w3c(?:-20150513)?", "w3\\.org/consortium/legal/.{0,20}copyright-software"),
    ("ijg", "jpeg", "independent jpeg group license", "ijg", "dev\\.w3\\.org/cvsweb/amaya/libjpeg"),
    ("curl", "curl", "curl license", "curl", "curl\\.se/docs/copyright"),
    ("qpl-1.0", "q public|qpl", "q public license(?: version 1\\.0)?", "qpl-1\\.0", "opensource\\.org/licenses?/qpl-1\\.0"),
    ("sleepycat", "sleepycat", "sleepycat license", "sleepycat", "opensource\\.org/licenses?/sleepycat"),
    ("zpl-2.1", "zope|zpl", "zope public license(?: version 2\\.[01])?", "zpl-2\\.[01]", "zope\\.(?:org|dev)/.{0,20}zpl"),
    ("tcl", "tcl", "tcl tk license", "tcl", "tcl\\.tk/software/tcltk/license"),
    ("fair", "fair license", "(?:the )?fair license", "fair", "fairlicense\\.org"),
    ("jam", "jam", "jam license", "jam", "workbench\\.perforce\\.com.{0,40}/license"),
    ("ncbi-pd", "united states government", "united states government work", "ncbi-pd", "ncbi\\.nlm\\.nih\\.gov/.{0,40}license"),
]

#: label, needed words, a sentence of the license's text
SENTENCES = [
    ("mit", "free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "substantial portions", "shall be included in all copies or substantial portions of the software"),
    ("bsd-3-clause", "endorse or promote", "neither the names? of .{1,80} may be used to endorse or promote products"),
    ("bsd-4-clause", "advertising materials", "all advertising materials mentioning features or use of this software must display"),
    ("bsd-2-clause", "source and binary", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("isc", "any purpose", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("apache-2.0", "compliance with the license", "you may not use this file except in compliance with the license"),
    ("gpl-3.0", "redistribute it", "redistribute it and or modify it under the terms of the gnu general public license .{0,80}version 3"),
    ("gpl-2.0", "redistribute it", "redistribute it and or modify it under the terms of the gnu general public license .{0,80}version 2"),
    ("lgpl-2.1", "redistribute it", "redistribute it and or modify it under the terms of the gnu lesser general public license .{0,80}version 2"),
    ("mpl-2.0", "source code form", "this source code form is subject to the terms of the mozilla public license"),
    ("bsl-1.0", "machine executable", "machine executable object code generated by a source language processor"),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "you just do", "you just do what the f[a-z*]+ you want to"),
    ("json", "used for good", "the software shall be used for good not evil"),
    ("cc0-1.0", "waive", "to the extent possible under law .{1,80} waived? all copyright"),
    ("public-domain", "public domain", "(?:is |are )?(?:hereby )?(?:placed|released|dedicated|put) (?:in|into|to) the public domain"),
    ("proprietary", "reserved", "all rights reserved"),
    ("proprietary", "confidential", "proprietary and confidential"),
    ("proprietary", "prior written", "no part of this .{1,60} may be reproduced .{1,120} without .{0,20}prior written permission"),
    ("noncommercial", "commercial", "(?:for )?non ?commercial use only"),
    ("gpl", "general public", "(?:gnu )?general public license"),
    ("apache", "apache", "apache license"),
    ("bsd", "bsd", "bsd(?: style)? license"),
    ("copyright", "copyright", "copyright (?:\xa9 |c )?(?:19|20)[0-9]{2}"),
]

#: Sentences that any better rule overrides.
VAGUE = {"gpl", "apache", "bsd", "copyright", "noncommercial"}


class Signature(NamedTuple):
    """A rule: its place in the list is its order among rules of one priority."""

    label: str
    family: str
    #: One of these must be in the text for the pattern to be tried.
    keywords: tuple[bytes, ...]
    pattern: re.Pattern
    priority: int
    confidence: float


def compiled(pattern: str) -> re.Pattern:
    """A pattern over lower-cased bytes that begins and ends with whole words."""
    marked = pattern.replace(" version ", "\0").replace(" ", "\1").encode("latin-1")
    spaced = marked.replace(b"\0", VERSION).replace(b"\1", GAP)
    return re.compile(rb"(?<![" + EDGE + rb"])(?:" + spaced + rb")(?![" + EDGE + rb"])", re.S)


def tag(identifiers: str) -> re.Pattern:
    """A machine-readable line that names the license."""
    lead = rb"(?<![0-9a-z])(?:spdx-license-identifier|license|licence)[\"']?[ \t]*[:=][ \t]*[\"']?"
    return re.compile(lead + b"(?:" + identifiers.encode() + rb")(?![0-9a-z.+-]*[0-9a-z+])")


def keywords_of(needed: str) -> tuple[bytes, ...]:
    """Only the first word of each needed phrase is looked up: what stands between words may differ."""
    return tuple(sorted({phrase.split(" ")[0].encode() for phrase in needed.split("|")}))


def signatures() -> list[Signature]:
    """All rules in their order: the families of each license, then the sentences."""
    rules = []
    for label, needed, title, identifiers, address in LICENSES:
        words = keywords_of(needed)
        host = re.match(r"(?:[a-z0-9-]|\\\.)+", address)[0].replace("\\", "").encode()
        leads = "licen[cs]ed|released|distributed|published|(?:made )?available"
        notice = f"(?:(?:{leads}) under|under the terms of)(?: the| a)? {title}"
        rules += [
            Signature(label, "tag", (b"licen",), tag(identifiers), 50, 1.0),
            Signature(label, "notice", words, compiled(notice), 40, 0.9),
            Signature(label, "address", (host,), re.compile(address.encode()), 30, 0.8),
            Signature(label, "title", words, compiled(title), 20, 0.6),
        ]
    for label, needed, sentence in SENTENCES:
        vague = label in VAGUE
        rules.append(
            Signature(
                label, "sentence", keywords_of(needed), compiled(sentence), 10 if vague else 45, 0.3 if vague else 0.95
            )
        )
    return rules
