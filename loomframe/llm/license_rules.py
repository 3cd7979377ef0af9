"""Ordered signature rules of license texts: hand-written forms for each family of licenses.

A family has its label, the identifiers and names it goes by (as regular expressions over ASCII-lower-cased text), words of
which every text naming it holds one, and its addresses. Each form of mention makes a rule of its own; rules are tried in order.
"""

from __future__ import annotations

from dataclasses import dataclass

# Families as (label, identifiers, names, keywords, address).
FAMILIES = [
    ("agpl-3.0", r"agpl-3\.0(?:-only|-or-later|\+)?", r"(?:gnu )?affero general public|agpl(?:v3| ?3\.0)?", "affero|agpl", r"gnu\.org/licenses/agpl"),
    ("lgpl-2.0", r"lgpl-2\.0(?:-only|-or-later|\+)?", r"(?:gnu )?library general public|lgpl(?:v2| ?2\.0)", "library general|lgpl", r"gnu\.org/licenses/old-licenses/lgpl-2\.0"),
    ("lgpl-2.1", r"lgpl-2\.1(?:-only|-or-later|\+)?", r"lgplv?2\.1|lgpl 2\.1", "lgpl", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1"),
    ("lgpl-3.0", r"lgpl-3\.0(?:-only|-or-later|\+)?", r"(?:gnu )?lesser general public|lgpl(?:v3| ?3\.0)?", "lesser general|lgpl", r"gnu\.org/licenses/lgpl-3\.0"),
    ("gpl-1.0", r"gpl-1\.0(?:-only|-or-later|\+)?", r"gplv1|gpl 1\.0", "gpl", r"gnu\.org/licenses/old-licenses/gpl-1\.0"),
    ("gpl-2.0", r"gpl-2\.0(?:-only|-or-later|\+)?", r"gplv2|gpl 2(?:\.0)?", "gpl", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0"),
    ("gpl-3.0", r"gpl-3\.0(?:-only|-or-later|\+)?", r"gplv3|gpl 3(?:\.0)?", "gpl", r"gnu\.org/licenses/gpl-3\.0"),
    ("gpl", r"gpl", r"(?:gnu )?general public|gnu gpl|gpl", "general public|gpl", r"gnu\.org/licenses/gpl\.(?:html|txt)"),
    ("gfdl", r"gfdl-1\.[123](?:-only|-or-later)?", r"(?:gnu )?free documentation", "documentation", r"gnu\.org/licenses/fdl"),
    ("apache-1.1", r"apache-1\.1", r"apache(?: software)? 1\.1", "apache", r"apache\.org/licenses/license-1\.1"),
    ("apache-2.0", r"apache-2\.0", r"apache(?: software)? 2(?:\.0)?", "apache", r"apache\.org/licenses/license-2\.0"),
    ("apache", r"apache", r"apache(?: software)?", "apache", r"apache\.org/licenses/?"),
    ("mit-0", r"mit-0", r"mit no attribution|mit-0", "mit", r"opensource\.org/licenses?/mit-0"),
    ("mit", r"mit", r"mit|expat", "mit|expat", r"opensource\.org/licenses?/mit"),
    ("x11", r"x11", r"x11|x consortium", "x11|x consortium", r"xfree86\.org/[a-z0-9.]+/license"),
    ("isc", r"isc", r"isc", "isc", r"opensource\.org/licenses?/isc"),
    ("bsd-1-clause", r"bsd-1-clause", r"bsd[- ]1[- ]clause|one[- ]clause bsd", "bsd", r"opensource\.org/licenses?/bsd-1-clause"),
    ("bsd-2-clause", r"bsd-2-clause", r"bsd[- ]2[- ]clause|2[- ]clause bsd|simplified bsd|freebsd", "bsd", r"opensource\.org/licenses?/bsd-2-clause"),
    ("bsd-3-clause", r"bsd-3-clause", r"bsd[- ]3[- ]clause|3[- ]clause bsd|(?:new|revised|modified) bsd", "bsd", r"opensource\.org/licenses?/bsd-3-clause"),
    ("bsd-4-clause", r"bsd-4-clause", r"bsd[- ]4[- ]clause|4[- ]clause bsd|original bsd", "bsd", r"spdx\.org/licenses/bsd-4-clause"),
    ("0bsd", r"0bsd", r"zero[- ]clause bsd|0bsd", "bsd", r"opensource\.org/licenses?/0bsd"),
    ("bsd", r"bsd", r"bsd", "bsd", r"opensource\.org/licenses?/bsd-license"),
    ("mpl-1.1", r"mpl-1\.[01]", r"mozilla public 1\.1|mpl ?1\.1", "mozilla|mpl", r"mozilla\.org/mpl/(?:mpl-)?1\.1"),
    ("mpl-2.0", r"mpl-2\.0", r"mozilla public 2(?:\.0)?|mpl ?2(?:\.0)?", "mozilla|mpl", r"mozilla\.org/(?:en-us/)?mpl/2\.0"),
    ("mpl", r"mpl", r"mozilla public|mpl", "mozilla|mpl", r"mozilla\.org/(?:en-us/)?mpl/?"),
    ("epl-1.0", r"epl-1\.0", r"eclipse public 1\.0|epl ?1\.0", "eclipse|epl", r"eclipse\.org/legal/epl-v10"),
    ("epl-2.0", r"epl-2\.0", r"eclipse public 2\.0|epl ?2\.0", "eclipse|epl", r"eclipse\.org/legal/epl-(?:2\.0|v20)"),
    ("epl", r"epl", r"eclipse public", "eclipse", r"eclipse\.org/legal/epl"),
    ("eupl", r"eupl-1\.[012]", r"european union public|eupl", "european union|eupl", r"joinup\.ec\.europa\.eu/[a-z0-9/._-]*eupl"),
    ("cddl", r"cddl-1\.[01]", r"common development and distribution|cddl", "common development|cddl", r"opensource\.org/licenses?/cddl"),
    ("cpl", r"cpl-1\.0", r"common public", "common", r"opensource\.org/licenses?/cpl"),
    ("ms-pl", r"ms-pl", r"microsoft public|ms-pl", "microsoft|ms-pl", r"opensource\.org/licenses?/ms-pl"),
    ("ms-rl", r"ms-rl", r"microsoft reciprocal|ms-rl", "microsoft|ms-rl", r"opensource\.org/licenses?/ms-rl"),
    ("artistic-1.0", r"artistic-1\.0(?:-perl)?", r"artistic 1\.0", "artistic", r"opensource\.org/licenses?/artistic-1\.0"),
    ("artistic-2.0", r"artistic-2\.0", r"artistic(?: 2\.0)?", "artistic", r"opensource\.org/licenses?/artistic-2\.0"),
    ("zlib", r"zlib", r"zlib(?:/libpng)?", "zlib", r"opensource\.org/licenses?/zlib"),
    ("boost", r"bsl-1\.0", r"boost software", "boost", r"boost\.org/license_1_0"),
    ("python", r"python-2\.0|psf-2\.0", r"python software foundation|psf", "python|psf", r"docs\.python\.org/[0-9.]+/license"),
    ("php", r"php-3\.0[01]?", r"php", "php", r"php\.net/license"),
    ("ruby", r"ruby", r"ruby", "ruby", r"ruby-lang\.org/[a-z/]*license"),
    ("postgresql", r"postgresql", r"postgresql", "postgresql", r"postgresql\.org/about/licen[cs]e"),
    ("openssl", r"openssl", r"openssl", "openssl", r"openssl\.org/source/license"),
    ("unlicense", r"unlicense", r"the unlicense|unlicense", "unlicense", r"unlicense\.org"),
    ("wtfpl", r"wtfpl", r"wtfpl|do what the f[a-z*]+ you want to public", "wtfpl|do what", r"wtfpl\.net"),
    ("cc0-1.0", r"cc0-1\.0", r"cc0(?: 1\.0)?|creative commons zero", "cc0|creative", r"creativecommons\.org/publicdomain/zero"),
    ("cc-by-4.0", r"cc-by-4\.0", r"cc[- ]by 4\.0|creative commons attribution 4\.0", "cc|creative", r"creativecommons\.org/licenses/by/4\.0"),
    ("cc-by-sa-4.0", r"cc-by-sa-4\.0", r"cc[- ]by[- ]sa 4\.0|creative commons attribution[- ]sharealike 4\.0", "cc|creative", r"creativecommons\.org/licenses/by-sa/4\.0"),
    ("cc-by-nc-4.0", r"cc-by-nc-4\.0", r"cc[- ]by[- ]nc 4\.0|creative commons attribution[- ]noncommercial 4\.0", "cc|creative", r"creativecommons\.org/licenses/by-nc/4\.0"),
    ("cc-by-nd-4.0", r"cc-by-nd-4\.0", r"cc[- ]by[- ]nd 4\.0|creative commons attribution[- ]noderivatives 4\.0", "cc|creative", r"creativecommons\.org/licenses/by-nd/4\.0"),
    ("cc-by-nc-sa", r"cc-by-nc-sa-[234]\.0", r"cc[- ]by[- ]nc[- ]sa|creative commons attribution[- ]noncommercial[- ]sharealike", "cc|creative", r"creativecommons\.org/licenses/by-nc-sa"),
    ("cc-by-nc-nd", r"cc-by-nc-nd-[234]\.0", r"cc[- ]by[- ]nc[- ]nd|creative commons attribution[- ]noncommercial[- ]noderivatives", "cc|creative", r"creativecommons\.org/licenses/by-nc-nd"),
    ("cc-by-3.0", r"cc-by-3\.0", r"cc[- ]by 3\.0|creative commons attribution 3\.0", "cc|creative", r"creativecommons\.org/licenses/by/3\.0"),
    ("cc-by-sa-3.0", r"cc-by-sa-3\.0", r"cc[- ]by[- ]sa 3\.0|creative commons attribution[- ]sharealike 3\.0", "cc|creative", r"creativecommons\.org/licenses/by-sa/3\.0"),
    ("cc", r"cc-by", r"creative commons(?: attribution)?(?:[- ]sharealike)?", "creative commons", r"creativecommons\.org/licenses/?"),
    ("ofl", r"ofl-1\.[01]", r"sil open font|open font", "font", r"(?:scripts\.sil\.org/ofl|openfontlicense\.org)"),
    ("odbl", r"odbl-1\.0", r"open database|odbl", "open database|odbl", r"opendatacommons\.org/licenses/odbl"),
    ("odc-by", r"odc-by-1\.0", r"open data commons attribution", "commons", r"opendatacommons\.org/licenses/by"),
    ("bsl-1.1", r"busl-1\.1", r"business source", "business source", r"mariadb\.com/bsl11"),
    ("sspl", r"sspl-1\.0", r"server side public|sspl", "server side|sspl", r"mongodb\.com/licensing/server-side-public-license"),
    ("elastic", r"elastic-2\.0", r"elastic(?: 2\.0)?", "elastic", r"elastic\.co/licensing/elastic-license"),
    ("openrail", r"openrail(?:\+\+|-m)?", r"(?:creativeml |bigscience )?open ?rail(?:-m|\+\+-m)?", "rail", r"huggingface\.co/spaces/[a-z-]+/license"),
    ("upl", r"upl-1\.0", r"universal permissive", "universal permissive", r"oss\.oracle\.com/licenses/upl"),
    ("nc-sa", r"ncsa", r"university of illinois/ncsa|ncsa", "ncsa", r"opensource\.org/licenses?/ncsa"),
    ("w3c", r"w3c", r"w3c software(?: notice)?(?: and)?", "w3c", r"w3\.org/consortium/legal/[a-z0-9/-]*software"),
    ("vim", r"vim", r"vim", "vim", r"vimdoc\.sourceforge\.net/[a-z/.]*uganda"),
    ("tcl", r"tcl", r"tcl/tk", "tcl/tk", r"tcl\.tk/software/tcltk/license"),
]

# Wordings of license texts and notices themselves, as (label, keyword, expression, priority).
WORDINGS = [
    ("mit", "permission is hereby granted", r"permission is hereby granted, free of charge, to any person obtaining a copy", 1),
    ("isc", "permission to use", r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose with or without fee", 1),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms, with or without modification, are permitted", 1),
    ("bsd-3-clause", "neither the name", r"neither the name of [^\n]{1,120}? nor the names of its contributors", 1),
    ("bsd-4-clause", "advertising materials", r"all advertising materials mentioning features or use of this software", 1),
    ("apache-2.0", "apache", r"apache license,? ?(?:\n ?)?version 2\.0(?:, january 2004)?", 1),
    ("gpl-2.0", "general public license", r"gnu general public license(?: as published by the free software foundation)?[;,]? (?:either )?version 2", 1),
    ("gpl-3.0", "general public license", r"gnu general public license(?: as published by the free software foundation)?[;,]? (?:either )?version 3", 1),
    ("lgpl-2.1", "lesser general public license", r"gnu lesser general public license[^\n]{0,80}?version 2\.1", 1),
    ("lgpl-3.0", "lesser general public license", r"gnu lesser general public license[^\n]{0,80}?version 3", 1),
    ("agpl-3.0", "affero general public license", r"gnu affero general public license[^\n]{0,80}?version 3", 1),
    ("mpl-2.0", "mozilla public license", r"subject to the terms of the mozilla public license,? v\. ?2\.0", 1),
    ("boost", "boost software license", r"boost software license - version 1\.0", 1),
    ("unlicense", "public domain", r"this is free and unencumbered software released into the public domain", 1),
    ("public-domain", "public domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain", 2),
    ("zlib", "as-is", r"this software is provided 'as-is', without any express or implied warranty", 1),
    ("proprietary", "rights reserved", r"all rights reserved", 3),
    ("proprietary", "proprietary", r"proprietary and confidential", 2),
    ("copyright", "copyright", r"copyright (?:\(c\)|©)? ?(?:19|20)[0-9]{2}(?:[-, ]+(?:19|20)[0-9]{2})*", 3),
    ("generic", "licen", r"see (?:the )?(?:file )?licen[cs]e(?:\.txt|\.md)? (?:file )?for (?:details|more information)", 3),
    ("generic", "licen", r"licen[cs]ed under (?:the )?[a-z0-9][a-z0-9 .-]{0,40}?licen[cs]e", 3),
]

# Every rule's expression holds one of these words; a text without any is not searched.
GATES = ("licen", "spdx", "copyright", "public domain", "rights reserved", "proprietary", "permission", "redistribution", "neither the name",
         "advertising materials", "provided 'as-is'", "opensource.org", "gnu.org", "mozilla.org", "eclipse.org", "unlicense", "wtfpl.net",
         "creativecommons.org", "openfontlicense", "sil.org/ofl", "opendatacommons", "mariadb.com/bsl11", "europa.eu", "w3.org", "vimdoc")


@dataclass(frozen=True)
class Rule:
    number: int
    label: str
    priority: int  # 1 outranks 2 and 3
    keywords: tuple[str, ...]  # the pattern is tried if the text holds one of them
    pattern: str


def rules() -> list[Rule]:
    """All rules in order: identifiers, grants, wordings, names, addresses."""
    edge, end = r"(?<![a-z0-9-])", r"(?![a-z0-9])"
    version = r"(?:,? (?:version|v\.?) ?[0-9]+(?:\.[0-9]+)?)?"
    out: list[tuple] = []
    for label, ids, _, _, _ in FAMILIES:
        out.append((label, 1, "spdx", rf"spdx-licen[cs]e-identifier ?: ?(?:{ids})(?![a-z0-9.+-])"))
    for label, _, names, keyword, _ in FAMILIES:
        out.append((label, 1, keyword, rf"licen[cs]ed under (?:the )?(?:terms of the )?(?:{names})(?:,? licen[cs]e){version}{end}"))
    out += [(label, priority, keyword, pattern) for label, keyword, pattern, priority in WORDINGS]
    for label, _, names, keyword, _ in FAMILIES:
        out.append((label, 2, keyword, rf"{edge}(?:{names}),? licen[cs]e{version}{end}"))
    for label, _, _, _, address in FAMILIES:
        out.append((label, 2, "sil.org|openfontlicense" if label == "ofl" else address.split(r"\.")[0], address))
    return [Rule(i, label, priority, tuple(keyword.split("|")), pattern) for i, (label, priority, keyword, pattern) in enumerate(out)]
