"""Ordered signature rules for license detection: a table of rows, no code of its own.

A rule is ``(label, tier, need, hint, regex)``. ``need`` and ``hint`` are lower-case
strings that every match contains (the keyword prefilter); tiers order the rules:
4 wording of a license text, 3 machine-readable identifier or address, 2 notice
("licensed under ..."), 1 bare name. Within a tier, earlier rules come first.

In the patterns a space stands for one or more characters that are not word
characters, ``~`` for none or more; matches begin and end at word boundaries and
ignore ASCII case. ``need`` and ``hint`` may list alternatives between ``|``, each without white space.
"""

from __future__ import annotations

import re
from itertools import groupby

#: A word character is an ASCII letter or digit or any non-ASCII character.
WORD_CHAR = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
GAP_CHAR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
WORD = WORD_CHAR + "+"

#: (phrase, label): the base detections.
BASE = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

_V = "(?:version |ver |v~)?"
_L = "licen[sc]e"

#: label, hint in every spelling of the name, the name, SPDX identifiers, address
_LICENSES = [
    ("gpl-3.0", "gnu|gpl", rf"(?:gnu (?:general public {_L}|gpl)|gpl) {_V}3(?:\.0)?", r"gpl-3\.0(?:-only|-or-later)?\+?", r"gnu\.org/licenses/(?:gpl-3\.0|gpl)(?:\.html|\.txt)?"),
    ("gpl-2.0", "gnu|gpl", rf"(?:gnu (?:general public {_L}|gpl)|gpl) {_V}2(?:\.0)?", r"gpl-2\.0(?:-only|-or-later)?\+?", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0(?:\.html|\.txt)?"),
    ("lgpl-3.0", "lesser|lgpl", rf"(?:gnu lesser general public {_L}|lgpl) {_V}3(?:\.0)?", r"lgpl-3\.0(?:-only|-or-later)?\+?", r"gnu\.org/licenses/lgpl(?:-3\.0)?(?:\.html|\.txt)?"),
    ("lgpl-2.1", "lesser|lgpl", rf"(?:gnu lesser general public {_L}|lgpl) {_V}2\.1", r"lgpl-2\.1(?:-only|-or-later)?\+?", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1(?:\.html|\.txt)?"),
    ("lgpl-2.0", "library|lgpl", rf"(?:gnu library general public {_L}|lgpl) {_V}2(?:\.0)?", r"lgpl-2\.0(?:-only|-or-later)?\+?", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.0(?:\.html|\.txt)?"),
    ("agpl-3.0", "affero|agpl", rf"(?:gnu affero general public {_L}|agpl)(?: {_V}3(?:\.0)?)?", r"agpl-3\.0(?:-only|-or-later)?\+?", r"gnu\.org/licenses/agpl(?:-3\.0)?(?:\.html|\.txt)?"),
    ("gfdl", "documentation", rf"gnu free documentation {_L}", r"gfdl-1\.[123](?:-only|-or-later)?", r"gnu\.org/licenses/fdl(?:-1\.[123])?(?:\.html|\.txt)?"),
    ("apache-2.0", "apache", rf"apache (?:software )?{_L} {_V}2(?:\.0)?", r"apache-2\.0", r"apache\.org/licenses/license-2\.0(?:\.html|\.txt)?"),
    ("apache-1.1", "apache", rf"apache (?:software )?{_L} {_V}1\.1", r"apache-1\.1", r"apache\.org/licenses/license-1\.1(?:\.html|\.txt)?"),
    ("apache-1.0", "apache", rf"apache (?:software )?{_L} {_V}1\.0", r"apache-1\.0", r"apache\.org/licenses/license-1\.0(?:\.html|\.txt)?"),
    ("mit", "mit", rf"mit {_L}", r"mit", r"opensource\.org/licenses?/mit(?:-license)?(?:\.php|\.html)?"),
    ("mit-0", "mit", rf"mit no attribution(?: {_L})?", r"mit-0", r"opensource\.org/licenses?/mit-0"),
    ("x11", "x11", rf"x11 {_L}", r"x11", r"spdx\.org/licenses/x11"),
    ("bsd-2-clause", "bsd", rf"(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd) {_L}", r"bsd-2-clause", r"opensource\.org/licenses?/bsd-2-clause"),
    ("bsd-3-clause", "bsd", rf"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd) {_L}", r"bsd-3-clause", r"opensource\.org/licenses?/bsd-3-clause"),
    ("bsd-4-clause", "bsd", rf"(?:bsd 4 clause|4 clause bsd|original bsd) {_L}", r"bsd-4-clause", r"spdx\.org/licenses/bsd-4-clause"),
    ("0bsd", "bsd", rf"(?:bsd zero clause|zero clause bsd|0bsd)(?: {_L})?", r"0bsd", r"opensource\.org/licenses?/0bsd"),
    ("bsd", "bsd|berkeley", rf"(?:berkeley software distribution|bsd(?: style)?) {_L}", r"bsd", r"opensource\.org/licenses?/bsd-license"),
    ("isc", "isc", rf"isc {_L}", r"isc", r"opensource\.org/licenses?/isc(?:-license\.txt)?"),
    ("mpl-2.0", "mozilla|mpl", rf"(?:mozilla public {_L}|mpl) {_V}2(?:\.0)?", r"mpl-2\.0(?:-no-copyleft-exception)?", r"mozilla\.org/(?:en-us/)?mpl/2\.0"),
    ("mpl-1.1", "mozilla|mpl", rf"(?:mozilla public {_L}|mpl) {_V}1\.1", r"mpl-1\.1", r"mozilla\.org/(?:en-us/)?mpl/1\.1"),
    ("epl-2.0", "eclipse|epl", rf"(?:eclipse public {_L}|epl) {_V}2(?:\.0)?", r"epl-2\.0", r"eclipse\.org/legal/epl-2\.0"),
    ("epl-1.0", "eclipse|epl", rf"(?:eclipse public {_L}|epl) {_V}1(?:\.0)?", r"epl-1\.0", r"eclipse\.org/legal/epl-v10(?:\.html)?"),
    ("cddl-1.0", "development|cddl", rf"(?:common development and distribution {_L}|cddl)(?: {_V}1\.0)?", r"cddl-1\.0", r"opensource\.org/licenses?/cddl-1\.0"),
    ("cpl-1.0", "common", rf"common public {_L}(?: {_V}1\.0)?", r"cpl-1\.0", r"opensource\.org/licenses?/cpl1\.0"),
    ("eupl-1.2", "european|eupl", rf"(?:european union public {_L}(?: {_V}1\.2)?|eupl {_V}1\.2)", r"eupl-1\.2", r"joinup\.ec\.europa\.eu/(?:collection/)?eupl"),
    ("osl-3.0", "software", rf"open software {_L}(?: {_V}3\.0)?", r"osl-3\.0", r"opensource\.org/licenses?/osl-3\.0"),
    ("afl-3.0", "academic", rf"academic free {_L}(?: {_V}3\.0)?", r"afl-3\.0", r"opensource\.org/licenses?/afl-3\.0"),
    ("artistic-2.0", "artistic", rf"artistic {_L} {_V}2(?:\.0)?", r"artistic-2\.0", r"perlfoundation\.org/artistic[-_]license[-_]2[._]0"),
    ("artistic-1.0", "artistic", rf"artistic {_L}(?: {_V}1(?:\.0)?)?", r"artistic-1\.0(?:-perl|-cl8)?", r"opensource\.org/licenses?/artistic-(?:license-)?1\.0"),
    ("boost-1.0", "boost", rf"boost software {_L}(?: {_V}1\.0)?", r"bsl-1\.0", r"boost\.org/license[-_]1[-_]0\.txt"),
    ("busl-1.1", "business", rf"business source {_L}(?: {_V}1\.1)?", r"busl-1\.1", r"mariadb\.com/bsl11"),
    ("sspl-1.0", "server|sspl", rf"(?:server side public {_L}|sspl)(?: {_V}1(?:\.0)?)?", r"sspl-1\.0", r"mongodb\.com/licensing/server-side-public-license"),
    ("elastic-2.0", "elastic", rf"elastic {_L}(?: {_V}2\.0)?", r"elastic-2\.0", r"elastic\.co/licensing/elastic-license"),
    ("unlicense", "unlicense", r"the unlicense", r"unlicense", r"unlicense\.org"),
    ("wtfpl", "public|wtfpl", rf"(?:do what the fuck you want to public {_L}|wtfpl)", r"wtfpl", r"wtfpl\.net"),
    ("zlib", "zlib", rf"(?:zlib|zlib libpng) {_L}", r"zlib", r"opensource\.org/licenses?/zlib(?:-license\.php)?"),
    ("openssl", "openssl", rf"openssl {_L}", r"openssl", r"openssl\.org/source/license(?:\.html)?"),
    ("php-3.01", "php", rf"php {_L}(?: {_V}3\.01)?", r"php-3\.01", r"php\.net/license/3[_.]01(?:\.txt)?"),
    ("python-2.0", "python|psf", rf"(?:python software foundation {_L}|psf {_L})(?: {_V}2)?", r"(?:python-2\.0|psf-2\.0)", r"python\.org/(?:psf/license|[0-9.]+/license)"),
    ("postgresql", "postgresql", rf"postgresql {_L}", r"postgresql", r"opensource\.org/licenses?/postgresql"),
    ("ncsa", "ncsa", rf"(?:university of illinois )?ncsa open source {_L}", r"ncsa", r"opensource\.org/licenses?/ncsa"),
    ("upl-1.0", "permissive", rf"universal permissive {_L}(?: {_V}1\.0)?", r"upl-1\.0", r"oss\.oracle\.com/licenses/upl"),
    ("ms-pl", "microsoft", rf"microsoft public {_L}", r"ms-pl", r"opensource\.org/licenses?/ms-pl"),
    ("ms-rl", "microsoft", rf"microsoft reciprocal {_L}", r"ms-rl", r"opensource\.org/licenses?/ms-rl"),
    ("ofl-1.1", "font", rf"(?:sil open font {_L}|open font {_L})(?: {_V}1\.1)?", r"ofl-1\.1(?:-rfn|-no-rfn)?", r"scripts\.sil\.org/ofl"),
    ("odbl-1.0", "database|odbl", rf"(?:open database {_L}|odbl)(?: {_V}1\.0)?", r"odbl-1\.0", r"opendatacommons\.org/licenses/odbl"),
    ("pddl-1.0", "dedication|pddl", rf"(?:public domain dedication and {_L}|pddl)(?: {_V}1\.0)?", r"pddl-1\.0", r"opendatacommons\.org/licenses/pddl"),
    ("cc0-1.0", "zero|cc0", rf"(?:creative commons zero|cc0)(?: {_V}1\.0)?(?: universal)?", r"cc0-1\.0", r"creativecommons\.org/publicdomain/zero/1\.0"),
    ("cc-by-nc-nd", "c", rf"(?:creative commons attribution non~commercial no~deriv(?:s|ative|atives)|cc by nc nd)(?: {_V}[1-4]\.[05])?", r"cc-by-nc-nd-[1-4]\.[05]", r"creativecommons\.org/licenses/by-nc-nd/[1-4]\.[05]"),
    ("cc-by-nc-sa", "c", rf"(?:creative commons attribution non~commercial share~alike|cc by nc sa)(?: {_V}[1-4]\.[05])?", r"cc-by-nc-sa-[1-4]\.[05]", r"creativecommons\.org/licenses/by-nc-sa/[1-4]\.[05]"),
    ("cc-by-nc", "c", rf"(?:creative commons attribution non~commercial|cc by nc)(?: {_V}[1-4]\.[05])?", r"cc-by-nc-[1-4]\.[05]", r"creativecommons\.org/licenses/by-nc/[1-4]\.[05]"),
    ("cc-by-nd", "c", rf"(?:creative commons attribution no~deriv(?:s|ative|atives)|cc by nd)(?: {_V}[1-4]\.[05])?", r"cc-by-nd-[1-4]\.[05]", r"creativecommons\.org/licenses/by-nd/[1-4]\.[05]"),
    ("cc-by-sa", "c", rf"(?:creative commons attribution share~alike|cc by sa)(?: {_V}[1-4]\.[05])?", r"cc-by-sa-[1-4]\.[05]", r"creativecommons\.org/licenses/by-sa/[1-4]\.[05]"),
    ("cc-by", "c", rf"(?:creative commons attribution|cc by)(?: {_V}[1-4]\.[05])?", r"cc-by-[1-4]\.[05]", r"creativecommons\.org/licenses/by/[1-4]\.[05]"),
]

_NOTICE = r"(?:licen[sc]ed|released|distributed|published|provided|redistributed|covered|governed|(?:made )?available) (?:under|by|subject to) (?:either )?(?:the )?(?:terms (?:and conditions )?of (?:the )?)?"

#: What every match of a bare name contains; the strings of the gate over all documents.
_NAME_NEED = {
    "gpl-3.0": "gpl|licen", "gpl-2.0": "gpl|licen", "lgpl-3.0": "gpl|licen", "lgpl-2.1": "gpl|licen", "lgpl-2.0": "gpl|licen",
    "agpl-3.0": "gpl|licen", "mit-0": "attribution", "0bsd": "bsd", "mpl-2.0": "mpl|licen", "mpl-1.1": "mpl|licen",
    "epl-2.0": "epl|licen", "epl-1.0": "epl|licen", "cddl-1.0": "cddl|licen", "eupl-1.2": "eupl|licen", "sspl-1.0": "sspl|licen",
    "wtfpl": "wtfpl|licen", "odbl-1.0": "odbl|licen", "pddl-1.0": "pddl|licen",
    "cc0-1.0": "cc0|commons", "cc-by-nc-nd": "cc|commons", "cc-by-nc-sa": "cc|commons", "cc-by-nc": "cc|commons",
    "cc-by-nd": "cc|commons", "cc-by-sa": "cc|commons", "cc-by": "cc|commons",
}

#: label, need, hint, wording
_TEXTS = [
    ("mit", "permission", "obtaining", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "permission", "substantial", "this permission notice shall be included in all copies or substantial portions of the software"),
    ("isc", "permission", "fee", "permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution", "binary", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "neither", "endorse", "neither the name of .{1,200}? may be used to endorse or promote products"),
    ("bsd-4-clause", "advertising", "mentioning", "all advertising materials mentioning features or use of this software must display"),
    ("gpl", "redistribute", "modify", r"you can redistribute it and or modify it under the terms of the gnu (?:lesser |affero |library )?general public licen[sc]e"),
    ("gpl-3.0", "either", "later", r"either version 3 of the licen[sc]e or (?:at your option )?any later version"),
    ("gpl-2.0", "either", "later", r"either version 2 of the licen[sc]e or (?:at your option )?any later version"),
    ("gpl", "warranty", "merchantability", "without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("lgpl", "combined", "library", "a combined work is a work produced by combining or linking an application with the library"),
    ("agpl-3.0", "remote", "interaction", "remote network interaction use with the gnu general public licen[sc]e"),
    ("apache-2.0", "compliance", "apache", r"you may not use this file except in compliance with the licen[sc]e(?=.{0,400}apache)"),
    ("apache", "patent", "contributor", r"grant of patent licen[sc]e subject to the terms and conditions of this licen[sc]e each contributor"),
    ("mpl-2.0", "source", "mozilla", r"this source code form is subject to the terms of the mozilla public licen[sc]e v(?:ersion)?~2\.0"),
    ("unlicense", "domain", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("cc0-1.0", "affirmer", "waive", "affirmer hereby overtly fully permanently irrevocably and unconditionally waives"),
    ("public-domain", "domain", "dedicated", "(?:has been |is |are )?(?:hereby )?dedicated to the public domain"),
    ("public-domain", "domain", "public", "(?:is|are) (?:hereby )?(?:placed )?in the public domain"),
    ("zlib", "provided", "implied", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("boost-1.0", "permission", "organization", "permission is hereby granted free of charge to any person or organization obtaining a copy"),
    ("artistic-1.0", "artistic", "holder", "the copyright holder maintains some semblance of artistic control"),
    ("ofl-1.1", "font", "itself", "neither the font software nor any of its individual components .{0,80}? may be sold by itself"),
    ("wtfpl", "fuck", "just", "you just do what the fuck you want to"),
    ("x11", "consortium", "advertising", "the name of the x consortium shall not be used in advertising"),
    ("epl", "eclipse", "accompanying", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e"),
    ("ms-pl", "accept", "software", "if you use the software you accept this licen[sc]e if you do not accept the licen[sc]e do not use the software"),
    ("proprietary", "reserved", "copyright", r"copyright .{0,120}? all rights reserved"),
    ("proprietary", "confidential", "proprietary", "(?:confidential and proprietary|proprietary and confidential)"),
    ("proprietary", "reproduced", "written", "may not be reproduced .{0,120}? without (?:the )?(?:express |prior )*written (?:permission|consent)"),
    ("non-commercial", "commercial", "only", "(?:for )?non~commercial use only"),
    ("non-commercial", "commercial", "purposes", "may not be used for commercial purposes"),
    ("research-only", "research", "only", "for (?:academic |internal )?research (?:use|purposes) only"),
    ("copyright", "copyright", "19|20", r"copyright c (?:19|20)[0-9]{2}(?:~(?:19|20)[0-9]{2})?"),
    ("copyright", "copyright", "©", r"copyright ©(?: |)(?:19|20)[0-9]{2}(?:~(?:19|20)[0-9]{2})?"),
]


#: The words that a keyword is in matches, where not itself; ``*``: and any ending; none: no word of its own.
_AS_WORDS = {
    "licen": ("licen*", "unlicense"), "gpl": ("gpl", "lgpl", "agpl"), "bsd": ("bsd", "0bsd", "freebsd"), "commercial": ("commercial", "noncommercial"),
    "waive": ("waives",), "c": (), "19": (), "20": (), "©": (),
}


def whole_words(keywords: str, regex: str) -> list[str]:
    """The keywords of a ``need`` or ``hint`` as words (of an address its first part): every match of
    the rule's ``regex`` holds one of them from word boundary to word boundary. None: no such words are known."""
    if "(?=" in regex and keywords in regex.split("(?=")[1]:
        return []
    found = [_AS_WORDS.get(k, (k.split(".")[0],)) for k in keywords.split("|")]
    return sorted({w for words in found for w in words}) if all(found) else []


#: Words beside needs and hints that make the phrases of rules telling.
BESIDE = ["c", "consent", "copy", "except", "file", "forms", "free", "identifier", "network", "person", "portions", "rights", "use", "version", "work", "©*"]


def _spellings(pattern: str) -> list[str]:
    """The words of all that a pattern matches: every way through it, anything but a letter, a digit
    or © as a blank, what isn't fixed as ``#``, and neither of what is only looked ahead at."""

    def ways(i: int) -> tuple[list[str], int]:
        out, way = [], [""]
        while i < len(pattern) and pattern[i] != ")":
            c = pattern[i]
            if c == "|":
                out, way, i = out + way, [""], i + 1
                continue
            if c == "(":
                part, j = ways(i + 3)
                part, i = ([""] if pattern[i + 2] == "=" else part), j + 1
            elif c == "[":
                part, i = ["#"], pattern.index("]", i) + 1
            elif c == "\\":
                part, i = [" "], i + 2
            else:
                part, i = {".": [" # "], "~": ["", " "]}.get(c, [c if c.isalnum() or c == "©" else " "]), i + 1
            if pattern[i : i + 1] == "{":
                i = pattern.index("}", i) + 1
                i += pattern[i : i + 1] == "?"
            elif pattern[i : i + 1] in ("?", "*", "+"):
                part, i = {"?": ["", *part], "*": ["", " # "], "+": part}[pattern[i]], i + 1
            way = [x + y for x in way for y in part]
        return out + way, i

    return ways(0)[0]


def telling_phrases(core: str, keywords: set[str]) -> list[str]:
    """Runs of neighbouring keywords (without ``*``), one of which is in every match of ``core``. None: not known."""

    def keyword(word: str) -> str | None:
        return next((k.rstrip("*") for k in keywords if word == k or k[-1] == "*" and word.startswith(k[:-1])), None)

    found = set()
    for words in {tuple(x.split()) for x in _spellings(core)}:
        runs = [tuple(run) for held, run in groupby(map(keyword, words), bool) if held]
        if not runs:
            return []
        found.add(" ".join(max(runs, key=len)))
    return sorted(x for x in found if not any(y != x and f" {y} " in f" {x} " for y in found))


def to_regex(pattern: str) -> str:
    """The table's shorthand as a Java (and Python) regular expression."""
    body = pattern.replace("~", GAP_CHAR + "*+").replace(" ", GAP_CHAR + "++")
    ends = "" if pattern.endswith(")") and "(?=" in pattern else f"(?!{WORD_CHAR})"
    return f"(?<!{WORD_CHAR})(?is:{body}){ends}"


def signatures() -> list[tuple[str, int, str, str, str, str]]:
    """``(label, tier, need, hint, pattern, core)`` of the rules, best first; ``core`` is the part of the pattern that names the license."""
    out = [(label, 4, need, hint, p, p) for label, need, hint, p in _TEXTS]
    for label, hint, name, spdx, url in _LICENSES:
        names = "|".join(re.findall(r"(?:^|\|)(?:\(\?:)?([a-z0-9]+)", spdx))
        out.append((label, 3, "spdx", names, rf"spdx license identifier {spdx}", rf"spdx license identifier {spdx}"))
        host = url.split("/")[0].replace("\\", "")
        out.append((label, 3, host, host, rf"(?:https?://)?(?:www\.)?{url}", url))
    for label, hint, name, _, _ in _LICENSES:
        need = _NAME_NEED.get(label, "licen")
        out.append((label, 2, need, hint, _NOTICE + name, name))
    for label, hint, name, _, _ in _LICENSES:
        out.append((label, 1, _NAME_NEED.get(label, "licen"), hint, name, name))
    return out


def rules() -> list[tuple[str, int, str, str, str]]:
    """``(label, tier, need, hint, regex)``, best first. ``need`` may list alternatives between ``|``."""
    return [(label, tier, need, hint, to_regex(pattern)) for label, tier, need, hint, pattern, _ in signatures()]
