"""Signature rules for license scans: names, phrases around names, and notices.

A rule is a regular expression over the words of a text, joined by one space with a space at either
end.  Its keyword must occur before the expression is tried, so every match holds it.  Of detections where one contains the other, the
one of higher priority stays.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    priority: int
    keyword: str
    pattern: str


# Licenses with the word that gates them, their names as expressions, and their short identifiers as words.
LICENSES = (
    ("agpl-3.0", "affero", r"(?:gnu )?affero general public license(?: v(?:ersion )?3| 3)?", r"agpl(?: v?3)?(?: 0)?(?: or later| only)?"),
    ("apache-1.1", "apache", r"apache (?:software )?license (?:version )?1 1", r"apache 1 1"),
    ("apache-2.0", "apache", r"apache (?:software )?license,? (?:version |v )?v?2(?: 0)?", r"apache 2(?: 0)?"),
    ("artistic-2.0", "artistic", r"artistic license(?: (?:version )?2(?: 0)?)?", r"artistic 2 0"),
    ("bsd-2-clause", "bsd", r"(?:simplified bsd|bsd 2 clause|2 clause bsd|freebsd) license", r"bsd 2 clause"),
    ("bsd-3-clause", "bsd", r"(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd) license", r"bsd 3 clause"),
    ("bsd-4-clause", "bsd", r"(?:original bsd|bsd 4 clause|4 clause bsd) license", r"bsd 4 clause"),
    ("bsl-1.0", "boost", r"boost software license(?: version)?(?: 1 0)?", r"bsl 1 0"),
    ("cc-by-4.0", "attribution", r"(?:creative commons )?attribution (?:4 0 international|international 4 0)(?: public)? license", r"cc by 4 0"),
    ("cc-by-3.0", "attribution", r"(?:creative commons )?attribution 3 0(?: unported)? license", r"cc by 3 0"),
    ("cc-by-sa", "attribution", r"(?:creative commons )?attribution share ?alike(?: [1-4] 0)?(?: international| unported)?(?: public)? license", r"cc by sa(?: [1-4] 0)?"),
    ("cc-by-nc", "attribution", r"(?:creative commons )?attribution non ?commercial(?: [1-4] 0)?(?: international| unported)?(?: public)? license", r"cc by nc(?: [1-4] 0)?"),
    ("cc-by-nd", "attribution", r"(?:creative commons )?attribution no ?derivatives(?: [1-4] 0)?(?: international| unported)?(?: public)? license", r"cc by nd(?: [1-4] 0)?"),
    ("cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?(?: license)?", r"cc0 1 0"),
    ("cddl-1.0", "development and distribution", r"common development and distribution license(?: (?:version )?1 [01])?", r"cddl 1 [01]"),
    ("cpl-1.0", "common public", r"common public license(?: (?:version |v)?1 0)?", r"cpl 1 0"),
    ("ecl-2.0", "educational", r"educational community license(?: (?:version )?[12] 0)?", r"ecl [12] 0"),
    ("epl-1.0", "eclipse", r"eclipse public license (?:version |v ?)?1 0", r"epl 1 0"),
    ("epl-2.0", "eclipse", r"eclipse public license (?:version |v ?)?2 0", r"epl 2 0"),
    ("eupl-1.2", "european union", r"european union public licen[cs]e(?: (?:version |v ?)?1 [012])?", r"eupl 1 [012]"),
    ("fdl-1.3", "documentation", r"(?:gnu )?free documentation license(?: version)?(?: 1 [123])?", r"gfdl 1 [123](?: or later| only)?"),
    ("gpl-1.0", "general public", r"(?:gnu )?general public license (?:version |v ?)1(?: 0)?", r"gpl v?1(?: 0)?(?: or later| only)?"),
    ("gpl-2.0", "general public", r"(?:gnu )?general public license (?:version |v ?)2(?: 0)?", r"gpl v?2(?: 0)?(?: or later| only)?"),
    ("gpl-3.0", "general public", r"(?:gnu )?general public license (?:version |v ?)3(?: 0)?", r"gpl v?3(?: 0)?(?: or later| only)?"),
    ("isc", "isc", r"isc license", r"isc"),
    ("lgpl-2.0", "general public", r"(?:gnu )?(?:lesser|library) general public license (?:version |v ?)2(?: 0)?", r"lgpl v?2(?: 0)?(?: or later| only)?"),
    ("lgpl-2.1", "general public", r"(?:gnu )?(?:lesser|library) general public license (?:version |v ?)2 1", r"lgpl v?2 1(?: or later| only)?"),
    ("lgpl-3.0", "general public", r"(?:gnu )?lesser general public license (?:version |v ?)3(?: 0)?", r"lgpl v?3(?: 0)?(?: or later| only)?"),
    ("mit", "licen", r"(?:mit|expat) license", r"mit"),
    ("mit-0", "mit", r"mit no attribution(?: license)?", r"mit 0"),
    ("mpl-1.1", "mozilla", r"mozilla public license (?:version |v ?)?1 1", r"mpl 1 1"),
    ("mpl-2.0", "mozilla", r"mozilla public license (?:version |v ?)?2 0", r"mpl 2 0"),
    ("ms-pl", "microsoft", r"microsoft public license", r"ms pl"),
    ("ms-rl", "microsoft", r"microsoft reciprocal license", r"ms rl"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa open source license", r"ncsa"),
    ("odbl-1.0", "database", r"open (?:data commons open )?database license(?: v?1 0)?", r"odbl 1 0"),
    ("ofl-1.1", "font", r"(?:sil )?open font license(?: version)?(?: 1 [01])?", r"ofl 1 [01]"),
    ("osl-3.0", "open software", r"open software license(?: (?:version |v ?)?3 0)?", r"osl 3 0"),
    ("php-3.01", "php", r"php license(?: version)?(?: 3 0[01]?)?", r"php 3 0[01]?"),
    ("postgresql", "postgresql", r"postgresql licen[cs]e", r"postgresql"),
    ("psf-2.0", "python", r"python software foundation license(?: version)?(?: 2)?", r"(?:psf|python) 2 0"),
    ("unlicense", "unlicense", r"(?:the )?unlicense", r"unlicense"),
    ("upl-1.0", "universal permissive", r"universal permissive license(?: v?1 0)?", r"upl 1 0"),
    ("wtfpl", "wtfpl", r"wtfpl(?: license)?(?: version 2)?", r"wtfpl"),
    ("x11", "x11", r"x11 license", r"x11"),
    ("zlib", "zlib", r"zlib(?: libpng)? license", r"zlib"),
    ("zpl-2.1", "zope", r"zope public license(?: (?:version |v ?)?2 1)?", r"zpl 2 1"),
)

# Notices that name no version.
NOTICES = (
    ("apache-2.0-notice", "apache-2.0", 5, "apache", r"licensed under the apache license version 2 0(?: the license)? you may not use this file except in compliance with the license"),
    ("apache-url", "apache-2.0", 4, "apache org", r"www apache org licenses license 2 0"),
    ("gpl-any", "gpl", 1, "general public", r"(?:gnu )?general public license"),
    ("lgpl-any", "lgpl", 1, "general public", r"(?:gnu )?(?:lesser|library) general public license"),
    ("gpl-redistribute", "gpl", 5, "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl-redistribute", "lgpl", 5, "redistribute", r"you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("gpl-later", "gpl", 2, "general public", r"general public license (?:\S+ ){0,12}?any later version"),
    ("gpl-url", "gpl", 4, "gnu org", r"www gnu org licenses(?: (?:gpl|lgpl|agpl)(?: [23] \d)?(?: html| txt)?)?"),
    ("mit-permission", "mit", 5, "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit-url", "mit", 4, "opensource", r"opensource org licenses mit(?: license(?: php)?)?"),
    ("bsd-any", "bsd", 1, "bsd", r"bsd(?: style)? license"),
    ("bsd-redistribution", "bsd", 5, "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-endorse", "bsd-3-clause", 4, "endorse", r"may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-url", "bsd", 4, "opensource", r"opensource org licenses bsd (?:license|[23] clause)"),
    ("isc-permission", "isc", 5, "permission to use", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("zlib-permission", "zlib", 5, "provided as is", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("boost-url", "bsl-1.0", 4, "boost org", r"www boost org license 1 0 txt"),
    ("mpl-notice", "mpl-2.0", 5, "mozilla", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-url", "mpl-2.0", 4, "mozilla org", r"(?:www )?mozilla org mpl 2 0"),
    ("cc-url-by", "cc-by", 4, "creativecommons", r"creativecommons org licenses by(?: [1-4] [05])?"),
    ("cc-url-other", "creative-commons", 4, "creativecommons", r"creativecommons org licenses by (?:nc|nd|sa)(?: (?:nc|nd|sa))?(?: [1-4] [05])?"),
    ("cc-url-zero", "cc0-1.0", 4, "creativecommons", r"creativecommons org publicdomain zero 1 0"),
    ("cc-any", "creative-commons", 1, "creative commons", r"creative commons(?: public)? licen[cs]e"),
    ("unlicense-text", "unlicense", 5, "public domain", r"this is free and unencumbered software released into the public domain"),
    ("public-domain", "public-domain", 2, "public domain", r"(?:released|dedicated|placed|is) (?:in|into|to) the public domain"),
    ("wtfpl-text", "wtfpl", 5, "what the fuck", r"do what the fuck you want to public license"),
    ("proprietary", "proprietary", 3, "proprietary", r"(?:proprietary and confidential|confidential and proprietary|proprietary license)"),
    ("all-rights", "all-rights-reserved", 2, "rights reserved", r"all rights reserved"),
    ("eula", "eula", 3, "license agreement", r"end user license agreement"),
    ("commercial", "commercial", 3, "commercial", r"(?:under|with) a commercial license"),
    ("copyleft", "copyleft", 1, "copyleft", r"copyleft license"),
    ("permissive", "permissive", 1, "permissive", r"permissive license"),
    ("source-available", "source-available", 3, "business source", r"business source license(?: 1 1)?"),
    ("elastic", "elastic-2.0", 3, "elastic", r"elastic license(?: 2 0)?"),
    ("sspl", "sspl-1.0", 3, "server side", r"server side public license(?: v?1)?"),
    ("commons-clause", "commons-clause", 3, "commons clause", r"commons clause license condition"),
)

VERB = r"(?:licen[cs]ed|released|distributed|available|published|provided|redistributed|covered|governed|made available)"


def rules() -> list[Rule]:
    """All rules: six phrasings for each license, and the notices."""
    out = [Rule(*n) for n in NOTICES]
    for label, keyword, name, tag in LICENSES:
        head = tag.split("(")[0].split("[")[0].split(" ")[0].rstrip("?")
        out += [
            Rule(f"{label}:name", label, 2, keyword, name),
            Rule(f"{label}:grant", label, 3, keyword, rf"{VERB} (?:\S+ ){{0,3}}?under (?:the )?(?:terms of )?(?:the )?{name}"),
            Rule(f"{label}:see", label, 3, keyword, rf"(?:see|read|subject to|terms of|conditions of|copy of|compliance with) (?:the )?{name}"),
            Rule(f"{label}:tag", label, 4, "spdx", rf"spdx license identifier {tag}"),
            Rule(f"{label}:field", label, 3, "licen", rf"licen[cs]es? (?:is |expression |type |text |id |name )?(?:the )?{tag}"),
            Rule(f"{label}:short", label, 2, head if head.isalnum() else "licen", rf"(?:under|the) {tag} licen[cs]e"),
        ]
    return out
