"""The signature rules of license scans: families of licenses, and the phrases each is named in.

Fixed values. A family is a label, a keyword that any of its texts holds in lower case, and regular
expressions for its name. The rules of a family follow from the templates below. A blank stands for
anything that may part two words of a notice: blanks, line ends and the marks of comments.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

VERSION = r"(?:,? *(?:(?:version|v\.?) *)?{0}(?:\.0)?(?![0-9.]*[0-9]))"


@dataclass(frozen=True)
class Rule:
    keyword: str
    regex: str
    label: str
    priority: int


# label, keyword, name
NAMES = [
    ("apache-1.0", "apache", r"apache(?: software)? licen[sc]e" + VERSION.format(1)),
    ("apache-1.1", "apache", r"apache(?: software)? licen[sc]e,? *(?:(?:version|v\.?) *)?1\.1"),
    ("apache-2.0", "apache", r"apache(?: software)? licen[sc]e" + VERSION.format(2)),
    ("apache", "apache", r"apache(?: software)? licen[sc]e"),
    ("mit", "mit", r"mit licen[sc]e"),
    ("mit", "expat", r"expat licen[sc]e"),
    ("mit", "x11", r"x11 licen[sc]e"),
    ("mit-0", "mit", r"mit no attribution licen[sc]e"),
    ("bsd-0-clause", "bsd", r"(?:zero-clause|0-clause) bsd licen[sc]e"),
    ("bsd-2-clause", "bsd", r"(?:simplified bsd|bsd[ -]2[ -]clause|2-clause bsd) licen[sc]e"),
    ("bsd-3-clause", "bsd", r"(?:new bsd|modified bsd|bsd[ -]3[ -]clause|3-clause bsd) licen[sc]e"),
    ("bsd-4-clause", "bsd", r"(?:original bsd|bsd[ -]4[ -]clause|4-clause bsd) licen[sc]e"),
    ("bsd", "bsd", r"bsd(?:-style)? licen[sc]e"),
    ("gpl-1.0", "general", r"(?:gnu )?general public licen[sc]e" + VERSION.format(1)),
    ("gpl-2.0", "general", r"(?:gnu )?general public licen[sc]e" + VERSION.format(2)),
    ("gpl-3.0", "general", r"(?:gnu )?general public licen[sc]e" + VERSION.format(3)),
    ("lgpl-2.0", "general", r"(?:gnu )?(?:lesser|library) general public licen[sc]e" + VERSION.format(2)),
    ("lgpl-2.1", "general", r"(?:gnu )?lesser general public licen[sc]e,? *(?:(?:version|v\.?) *)?2\.1"),
    ("lgpl-3.0", "general", r"(?:gnu )?lesser general public licen[sc]e" + VERSION.format(3)),
    ("lgpl", "general", r"(?:gnu )?(?:lesser|library) general public licen[sc]e"),
    ("agpl-1.0", "affero", r"(?:gnu )?affero general public licen[sc]e" + VERSION.format(1)),
    ("agpl-3.0", "affero", r"(?:gnu )?affero general public licen[sc]e" + VERSION.format(3)),
    ("agpl", "affero", r"(?:gnu )?affero general public licen[sc]e"),
    ("gfdl-1.1", "documentation", r"(?:gnu )?free documentation licen[sc]e,? *(?:(?:version|v\.?) *)?1\.1"),
    ("gfdl-1.2", "documentation", r"(?:gnu )?free documentation licen[sc]e,? *(?:(?:version|v\.?) *)?1\.2"),
    ("gfdl-1.3", "documentation", r"(?:gnu )?free documentation licen[sc]e,? *(?:(?:version|v\.?) *)?1\.3"),
    ("gfdl", "documentation", r"(?:gnu )?free documentation licen[sc]e"),
    ("mpl-1.0", "mozilla", r"mozilla public licen[sc]e" + VERSION.format(1)),
    ("mpl-1.1", "mozilla", r"mozilla public licen[sc]e,? *(?:(?:version|v\.?) *)?1\.1"),
    ("mpl-2.0", "mozilla", r"mozilla public licen[sc]e" + VERSION.format(2)),
    ("mpl", "mozilla", r"mozilla public licen[sc]e"),
    ("epl-1.0", "eclipse", r"eclipse public licen[sc]e" + VERSION.format(1)),
    ("epl-2.0", "eclipse", r"eclipse public licen[sc]e" + VERSION.format(2)),
    ("edl-1.0", "eclipse", r"eclipse distribution licen[sc]e"),
    ("cddl-1.0", "distribution", r"common development and distribution licen[sc]e" + VERSION.format(1)),
    ("cddl-1.1", "distribution", r"common development and distribution licen[sc]e,? *(?:(?:version|v\.?) *)?1\.1"),
    ("cpl-1.0", "common", r"common public licen[sc]e"),
    ("eupl-1.1", "european", r"european union public licen[sc]e,? *(?:(?:version|v\.?) *)?1\.1"),
    ("eupl-1.2", "european", r"european union public licen[sc]e,? *(?:(?:version|v\.?) *)?1\.2"),
    ("cecill-2.1", "cecill", r"cecill(?: free software)? licen[sc]e"),
    ("artistic-1.0", "artistic", r"artistic licen[sc]e" + VERSION.format(1)),
    ("artistic-2.0", "artistic", r"artistic licen[sc]e" + VERSION.format(2)),
    ("artistic", "artistic", r"artistic licen[sc]e"),
    ("boost-1.0", "boost", r"boost software licen[sc]e"),
    ("isc", "isc", r"isc licen[sc]e"),
    ("zlib", "zlib", r"zlib(?:/libpng)? licen[sc]e"),
    ("libpng", "libpng", r"libpng licen[sc]e"),
    ("openssl", "openssl", r"openssl licen[sc]e"),
    ("php-3.01", "php", r"php licen[sc]e"),
    ("python-2.0", "python", r"python(?: software foundation)? licen[sc]e"),
    ("ruby", "ruby", r"ruby licen[sc]e"),
    ("postgresql", "postgresql", r"postgresql licen[sc]e"),
    ("ncsa", "ncsa", r"(?:university of illinois/)?ncsa(?: open source)? licen[sc]e"),
    ("w3c", "w3c", r"w3c(?: software)?(?: notice and)? licen[sc]e"),
    ("unicode", "unicode", r"unicode(?:, inc\.)? licen[sc]e"),
    ("ofl-1.1", "font", r"(?:sil )?open font licen[sc]e"),
    ("odbl-1.0", "base", r"open data(?: commons open)? ?base licen[sc]e|open database licen[sc]e"),
    ("odc-by-1.0", "commons", r"open data commons attribution licen[sc]e"),
    ("pddl-1.0", "commons", r"open data commons public domain dedication and licen[sc]e"),
    ("osl-3.0", "software", r"open software licen[sc]e"),
    ("afl-3.0", "academic", r"academic free licen[sc]e"),
    ("ms-pl", "microsoft", r"microsoft public licen[sc]e"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[sc]e"),
    ("wtfpl", "want", r"do what the [a-z*]+ you want to public licen[sc]e"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"),
    ("bsl-1.1", "business", r"business source licen[sc]e"),
    ("elastic-2.0", "elastic", r"elastic licen[sc]e" + VERSION.format(2)),
    ("sspl-1.0", "server", r"server side public licen[sc]e"),
    ("qpl-1.0", "public", r"q public licen[sc]e"),
    ("sleepycat", "sleepycat", r"sleepycat licen[sc]e"),
    ("vim", "vim", r"vim licen[sc]e"),
    ("tex-lppl-1.3", "latex", r"latex project public licen[sc]e"),
    ("mulan-2.0", "mulan", r"mulan permissive software licen[sc]e"),
    ("upl-1.0", "universal", r"universal permissive licen[sc]e"),
    ("opl-1.0", "publication", r"open publication licen[sc]e"),
    ("rail", "rail", r"(?:open)?rail(?:-[ms])? licen[sc]e"),
    ("rail", "responsible", r"responsible ai licen[sc]e"),
    ("commercial", "commercial", r"commercial licen[sc]e"),
    ("proprietary", "proprietary", r"proprietary licen[sc]e"),
]

# Creative Commons: label, short name, long name. Versions follow by rule.
COMMONS = [
    ("cc-by", "by", "attribution"),
    ("cc-by-sa", "by[- ]sa", "attribution[- ]sharealike"),
    ("cc-by-nc", "by[- ]nc", "attribution[- ]noncommercial"),
    ("cc-by-nd", "by[- ]nd", "attribution[- ]noderivatives"),
    ("cc-by-nc-sa", "by[- ]nc[- ]sa", "attribution[- ]noncommercial[- ]sharealike"),
    ("cc-by-nc-nd", "by[- ]nc[- ]nd", "attribution[- ]noncommercial[- ]noderivatives"),
]
COMMONS_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

# keyword, regex, label, priority
PHRASES = [
    ("copyright", r"copyright(?: *(?:\(c\)|©))? *[0-9]{4}(?:[-, ]+[0-9]{4})*", "copyright", 1),
    ("copyright", r"(?:©|\(c\)) *copyright", "copyright", 1),
    ("rights", r"all rights reserved", "reserved", 1),
    ("rights", r"some rights reserved", "some-rights", 2),
    ("domain", r"(?:in|into|to) the public domain", "public-domain", 2),
    ("domain", r"public domain dedication", "public-domain", 2),
    ("licen", r"dual[- ]licen[sc]ed", "dual", 2),
    ("licen", r"see (?:the )?licen[sc]e(?:\.(?:txt|md))? (?:file )?for", "reference", 1),
    ("licen", r"licen[sc]ed under", "reference", 1),
]

# keyword, regex, label: sentences of license texts and of the headers that refer to them.
SENTENCES = [
    ("granted", r"permission is hereby granted,? free of charge,? to any person obtaining a copy", "mit"),
    ("permission", r"the above copyright notice and this permission notice shall be included in all copies", "mit"),
    ("permission", r"permission to use, copy, modify,? and(?:/or)? distribute this software for any purpose", "isc"),
    ("redistribution", r"redistribution and use in source and binary forms,? with or without modification", "bsd"),
    ("redistribution", r"redistributions in binary form must reproduce the above copyright notice", "bsd"),
    ("endorse", r"be used to endorse or promote products derived from this software", "bsd-3-clause"),
    ("advertising", r"all advertising materials mentioning features or use of this software", "bsd-4-clause"),
    ("apache", r"apache\.org/licenses/license-2\.0", "apache-2.0"),
    ("altered", r"altered source versions must be plainly marked as such", "zlib"),
    ("unencumbered", r"this is free and unencumbered software released into the public domain", "unlicense"),
    ("mozilla", r"mozilla\.org/mpl/2\.0", "mpl-2.0"),
    ("mozilla", r"mozilla\.org/mpl/mpl-1\.1", "mpl-1.1"),
    ("eclipse", r"eclipse\.org/legal/epl-(?:2\.0|v20)", "epl-2.0"),
    ("eclipse", r"eclipse\.org/legal/epl-v10", "epl-1.0"),
    ("boost", r"boost\.org/license_1_0", "boost-1.0"),
    ("creativecommons", r"creativecommons\.org/publicdomain/zero/1\.0", "cc0-1.0"),
]

# Label without version, words before "General Public License", versions.
GNU = [
    ("gpl", "", ("1.0", "2.0", "3.0")),
    ("lgpl", "(?:lesser|library) ", ("2.0", "2.1", "3.0")),
    ("agpl", "affero ", ("1.0", "3.0")),
]

# keyword, short name, label
SHORT_NAMES = [
    ("apache", r"apache-2(?:\.0)?|apache ?v2(?:\.0)?|apache 2\.0", "apache-2.0"),
    ("clause", r"bsd[ -]2[ -]clause|2[ -]clause bsd", "bsd-2-clause"),
    ("clause", r"bsd[ -]3[ -]clause|3[ -]clause bsd", "bsd-3-clause"),
    ("clause", r"bsd[ -]4[ -]clause|4[ -]clause bsd", "bsd-4-clause"),
    ("mpl", r"mpl[- ]?v?2\.0", "mpl-2.0"),
    ("mpl", r"mpl[- ]?v?1\.1", "mpl-1.1"),
]

# What may stand between two words, and in place of a blank in a class.
_PARTS = r"\s#*/"
_END = r"(?![A-Za-z0-9])"
_BEGIN = r"(?<![A-Za-z0-9])"


def _wrapped(regex: str) -> str:
    """The expression with each blank as anything that may part two words."""

    def parts(found: re.Match) -> str:
        return found[0].replace(" ", _PARTS) if found[0].startswith("[") else f"[{_PARTS}]{found[1] or '+'}"

    return re.sub(r"\[[^\]]*\]| ([*?]?)", parts, regex)


def _rule(keyword: str, regex: str, label: str, priority: int) -> Rule:
    return Rule(keyword, f"(?i){_BEGIN}(?:{_wrapped(regex)}){_END}", label, priority)


def _named() -> list[Rule]:
    """A family by its name, by a sentence that grants it, and by its tag."""
    rules = []
    for label, keyword, name in NAMES:
        rules.append(_rule(keyword, name, label, 2))
        grant = r"(?:licen[sc]ed|released|distributed|published|available) under (?:the )?(?:terms of (?:the )?)?"
        rules.append(_rule(keyword, f"{grant}(?:{name})", label, 3))
        tag = label.replace(".", r"\.") + r"(?:-only|-or-later|\+)?"
        rules.append(_rule("spdx", rf"spdx-license-identifier: *{tag}", label, 4))
        rules.append(_rule(label, rf"licen[sc]e[\"']?(?: *[:=]| is) *[\"']?{tag}", label, 3))
    return rules


def _commons() -> list[Rule]:
    rules = []
    for label, short, long in COMMONS:
        for keyword, name in (("cc", f"cc[-\\x20]{short.replace(' ', chr(92) + 'x20')}"), ("commons", f"creative commons {long}")):
            for version in COMMONS_VERSIONS:
                number = version.replace(".", r"\.")
                regex = rf"{name}(?: international| unported| licen[sc]e)?[- ,]{{0,3}}(?:version )?{number}"
                rules.append(_rule(keyword, regex, f"{label}-{version}", 3))
            rules.append(_rule(keyword, rf"{name}(?![- ]?(?:sa|nc|nd|share|non|no))", label, 2))
        for version in COMMONS_VERSIONS:
            place = label.removeprefix("cc-") + "/" + version.replace(".", r"\.")
            rules.append(_rule("creativecommons", rf"creativecommons\.org/licenses/{place}", f"{label}-{version}", 3))
    return rules


def _gnu() -> list[Rule]:
    rules = []
    for family, kind, versions in GNU:
        for version in versions:
            number = version.removesuffix(".0").replace(".", r"\.") + (r"(?:\.0)?" if version.endswith(".0") else "")
            label, last = f"{family}-{version}", r"(?!\.?[0-9])"
            header = rf"{kind}general public licen[sc]e,? as published by the free software foundation"
            rules.append(_rule("foundation", rf"{header}[,;:]? (?:either )?version {number}{last}", label, 3))
            rules.append(_rule("gpl", rf"{family}(?:,? version |[- ]?v?\.? ?){number}{last}(?:-only|-or-later|\+)?", label, 2))
            rules.append(_rule("gnu.org", rf"gnu\.org/licenses/(?:old-licenses/)?{family}-{number}{last}", label, 3))
    return rules


def _rules() -> list[Rule]:
    rules = [*_named(), *_commons(), *_gnu()]
    rules.append(_rule("cc0", r"cc0(?:[- ]1\.0)?", "cc0-1.0", 3))
    rules += [_rule(k, r, label, 3) for k, r, label in SENTENCES]
    rules += [_rule(k, r, label, 2) for k, r, label in SHORT_NAMES]
    rules += [_rule(k, r, label, p) for k, r, label, p in PHRASES]
    return list(dict.fromkeys(rules))


RULES = _rules()

# Any text that a rule matches holds one of these in lower case.
TRIGGERS = (
    "licen", "spdx", "copyright", "reserved", "domain", "commons", "cc by", "cc-by", "cc0", "permission",
    "redistribution", "endorse", "advertising", "altered", "gpl", "apache", "clause", "mpl", "mozilla.org",
    "eclipse.org", "boost.org",
)
