"""Licence scan by sentence rules (operator 10).

Known licence sentences carry identifiers; a licence rule is an ordered sequence of identifiers. Every line and sentence
of a text is normalised and mapped to identifiers: sentences of the licences' own texts by a table, statements such as
"This project is licensed under the MIT License" by the phrases they open with and the licences' names, identifier tags
and expressions (``MIT OR Apache-2.0``) by their parts. Runs of identifiers are matched against the rules, the longest
rule first. Titles and "All rights reserved" may stand between the sentences of a rule; elsewhere the latter is a finding
of its own.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.jobs import pieces

# Public licences with the names they are stated by, in any case; the identifier is a name as well.
NAMES = {
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache 2.0 License", "Apache Version 2.0", "Apache 2.0", "Apache 2", "Apache Software License 2.0", "Apache Software License, Version 2.0"],
    "MIT": ["MIT License", "MIT Licence", "MIT", "Expat License", "MIT/Expat License", "MIT License (MIT)"],
    "MIT-0": ["MIT No Attribution License", "MIT No Attribution"],
    "ISC": ["ISC License", "ISC Licence", "ISC"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "BSD 2-Clause", "Simplified BSD License", "FreeBSD License", "BSD 2-Clause \"Simplified\" License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "BSD 3-Clause", "New BSD License", "Modified BSD License", "Revised BSD License", "BSD 3-Clause \"New\" or \"Revised\" License"],
    "BSD-4-Clause": ["BSD 4-Clause License", "4-Clause BSD License", "Original BSD License"],
    "BSD": ["BSD License", "BSD Licence", "BSD-style License", "BSD"],
    "0BSD": ["Zero-Clause BSD License", "BSD Zero Clause License", "Free Public License 1.0.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License v2", "GNU General Public License v2.0", "GNU General Public License 2", "GNU GPL v2", "GNU GPLv2", "GPLv2", "GPL v2", "GPL version 2", "GPL 2.0"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3", "GNU General Public License v3.0", "GNU General Public License 3", "GNU GPL v3", "GNU GPLv3", "GPLv3", "GPL v3", "GPL version 3", "GPL 3.0"],
    "GPL": ["GNU General Public License", "GNU GPL", "GPL"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "GNU LGPL v2.1", "LGPLv2.1", "LGPL v2.1", "LGPL 2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3", "GNU Lesser General Public License v3.0", "GNU LGPL v3", "LGPLv3", "LGPL v3", "LGPL 3.0"],
    "LGPL": ["GNU Lesser General Public License", "GNU LGPL", "LGPL"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "GNU Affero General Public License v3", "GNU Affero General Public License v3.0", "GNU Affero General Public License", "GNU AGPL v3", "GNU AGPLv3", "AGPLv3", "AGPL v3", "AGPL 3.0"],
    "MPL-1.1": ["Mozilla Public License, version 1.1", "Mozilla Public License 1.1"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "Mozilla Public License, v. 2.0", "Mozilla Public License v2.0", "MPL 2.0", "MPLv2"],
    "EPL-1.0": ["Eclipse Public License 1.0", "Eclipse Public License v1.0", "Eclipse Public License, version 1.0"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License v2.0", "Eclipse Public License v. 2.0", "Eclipse Public License, version 2.0", "Eclipse Public License - v 2.0"],
    "CDDL-1.0": ["Common Development and Distribution License 1.0", "Common Development and Distribution License", "CDDL 1.0"],
    "EUPL-1.2": ["European Union Public Licence 1.2", "European Union Public License 1.2", "EUPL v1.2", "EUPL 1.2"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0", "Boost Software License"],
    "Zlib": ["zlib License", "zlib/libpng License"],
    "Unlicense": ["Unlicense"],
    "WTFPL": ["Do What The Fuck You Want To Public License", "WTFPL v2"],
    "Artistic-2.0": ["Artistic License 2.0", "Artistic License, version 2.0"],
    "PSF-2.0": ["Python Software Foundation License", "PSF License"],
    "OFL-1.1": ["SIL Open Font License, Version 1.1", "SIL Open Font License 1.1", "SIL Open Font License"],
    "ODbL-1.0": ["Open Database License", "Open Data Commons Open Database License", "Open Database License v1.0", "ODbL"],
    "LPPL-1.3c": ["LaTeX Project Public License", "LaTeX Project Public License 1.3c", "LPPL 1.3c", "LPPL"],
    "MS-PL": ["Microsoft Public License", "Ms-PL License"],
    "MS-RL": ["Microsoft Reciprocal License", "Ms-RL License"],
    "OpenSSL": ["OpenSSL License", "OpenSSL Licence"],
    "SSPL-1.0": ["Server Side Public License", "Server Side Public License, version 1", "Server Side Public License v1", "SSPL"],
    "Ruby": ["Ruby License", "Ruby Licence"],
    "Vim": ["Vim License", "Vim Licence"],
    "NCSA": ["University of Illinois/NCSA Open Source License", "NCSA License"],
    "UPL-1.0": ["Universal Permissive License 1.0", "Universal Permissive License v1.0", "Universal Permissive License"],
    "Artistic-1.0": ["Artistic License 1.0", "Artistic License, version 1.0"],
    "AFL-3.0": ["Academic Free License 3.0", "Academic Free License v3.0", "Academic Free License"],
    "OSL-3.0": ["Open Software License 3.0", "Open Software License v3.0"],
    "ECL-2.0": ["Educational Community License, Version 2.0", "Educational Community License 2.0"],
    "CPL-1.0": ["Common Public License 1.0", "Common Public License, version 1.0", "Common Public License"],
    "PostgreSQL": ["PostgreSQL License", "PostgreSQL Licence"],
    "BUSL-1.1": ["Business Source License 1.1", "Business Source License"],
    "Elastic-2.0": ["Elastic License 2.0", "Elastic License, version 2.0", "Elastic License"],
    "CECILL-2.1": ["CeCILL License 2.1", "CeCILL 2.1", "CeCILL Free Software License Agreement v2.1"],
    "MulanPSL-2.0": ["Mulan Permissive Software License, Version 2", "Mulan PSL v2"],
    "X11": ["X11 License", "X Consortium License"],
    "W3C": ["W3C Software Notice and License", "W3C Software License"],
    "ODC-By-1.0": ["Open Data Commons Attribution License", "Open Data Commons Attribution License v1.0", "ODC-By"],
    "PDDL-1.0": ["Open Data Commons Public Domain Dedication and License", "Public Domain Dedication and License 1.0"],
    "CC0-1.0": ["CC0 1.0", "CC0", "CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal", "CC0 1.0 Universal Public Domain Dedication"],
}
#: The Creative Commons licences: marks of their parts, and versions.
CREATIVE = {"by": "Attribution", "sa": "ShareAlike", "nc": "NonCommercial", "nd": "NoDerivatives"}
CREATIVE_KINDS, CREATIVE_VERSIONS = ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd"), ("4.0", "3.0", "2.5", "2.0")
#: Endings of identifiers that name the same licence.
SAME = ("", "-only", "-or-later", "+")
# What a statement of a licence opens with (every choice of one from each list), and what may follow it.
STATEMENT = [
    ["", *(f"{which} {what} is" for which in ("this", "the") for what in ("project", "work", "program", "software", "file", "code", "source code", "library", "package", "document", "repository", "content", "article", "text", "dataset", "material")), "all code is", "it is"],
    ["licensed", "licenced", "released", "distributed", "available", "published", "provided", "made available", "dual licensed", "free software licensed"],
    ["under", "under the", "under the terms of", "under the terms of the", "under a", "under an"],
]
FOLLOWS = [
    "see license", "see the license", "see the license file", "see license file for details", "see the license file for details", "see license for details", "see license for more information",
    "see license md", "see license md for details", "see license txt", "see license txt for details", "see the accompanying license file", "unless otherwise noted", "unless noted otherwise", "or later", "or any later version",
    "or at your option any later version", "only",
]
#: Within a sentence, a name of one word (MIT, GPL) counts only at its end or before one of these; nothing counts after a denial.
AFTER_WORD = frozenset("see as which that unless but so and or with by for if except copyright c terms in on at from since while to".split())
DENIED = frozenset("not no never longer without isn wasn aren cannot".split())
BETWEEN = ["or", "and", "or the", "and the", "and or", "or a", "and a"]
# Sentences of public licence texts and notices.
SENTENCES = {
    "apache-2.0/licensed": ["Licensed under the Apache License, Version 2.0 (the \"License\")", "This project is licensed under the Apache License, Version 2.0 (the \"License\")"],
    "apache-2.0/compliance": ["you may not use this file except in compliance with the License", "You may obtain a copy of the License at"],
    "apache-2.0/as-is": ["Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"],
    "apache-2.0/language": ["See the License for the specific language governing permissions and limitations under the License"],
    "apache-2.0/text": ["Apache License Version 2.0, January 2004"],
    "mit/title": ["MIT License", "The MIT License (MIT)", "The MIT License"],
    "mit/grant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"],
    "mit-0/grant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so."],
    "mit/notice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software", "The above copyright notice and this permission notice (including the next paragraph) shall be included in all copies or substantial portions of the Software"],
    "mit/as-is": ["THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT"],
    "mit/liability": ["IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE"],
    "isc/grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"],
    "0bsd/grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "isc/as-is": ["THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS"],
    "gpl-3.0/text": ["GNU General Public License Version 3, 29 June 2007"],
    "gpl-2.0/text": ["GNU General Public License Version 2, June 1991"],
    "lgpl-3.0/text": ["GNU Lesser General Public License Version 3, 29 June 2007"],
    "lgpl-2.1/text": ["GNU Lesser General Public License Version 2.1, February 1999"],
    "agpl-3.0/text": ["GNU Affero General Public License Version 3, 19 November 2007"],
    "gpl/no-warranty": [f"This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE" for what in ("program", "library", "software", "file")],
    "gpl/received": [f"You should have received a copy of the GNU {kind}General Public License along with this {what}" for kind in ("", "Lesser ", "Affero ") for what in ("program", "library", "software")],
    "bsd/redistribution": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "bsd/source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"],
    "bsd/binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"],
    "bsd/advertising": ["All advertising materials mentioning features or use of this software must display the following acknowledgement:", "All advertising materials mentioning features or use of this software must display the following acknowledgment:"],
    "bsd/no-endorsement": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "mpl-2.0/subject": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "mpl-2.0/copy": ["If a copy of the MPL was not distributed with this file, You can obtain one at"],
    "epl-2.0/available": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v. 2.0 which is available at"],
    "epl-1.0/available": ["All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at"],
    "bsl-1.0/text": ["Boost Software License - Version 1.0 - August 17th, 2003", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at"],
    "zlib/as-is": ["This software is provided 'as-is', without any express or implied warranty"],
    "zlib/grant": ["Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"],
    "unlicense/free": ["This is free and unencumbered software released into the public domain"],
    "unlicense/anyone": ["Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means"],
    "public-domain/dedicated": ["This work is dedicated to the public domain", "This file is in the public domain", "This work is in the public domain", "Released into the public domain", "Placed in the public domain", "This code is in the public domain"],
    "openssl/acknowledgement": ["This product includes software developed by the OpenSSL Project for use in the OpenSSL Toolkit."],
    "ncsa/grant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal with the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"],
    "postgresql/grant": ["Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies"],
    "lppl-1.3c/work": ["This work may be distributed and/or modified under the conditions of the LaTeX Project Public License, either version 1.3 of this license or (at your option) any later version", "This work may be distributed and/or modified under the conditions of the LaTeX Project Public License, either version 1.3c of this license or (at your option) any later version"],
    "cc0/waived": ["To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"],
    "proprietary/reserved": ["All rights reserved"],
    "proprietary/confidential": ["Proprietary and confidential", "Unauthorized copying of this file, via any medium is strictly prohibited"],
}
#: The notices of the GNU licences: kind, licence of each version, and what is free software.
FREE_SOFTWARE = {"General": {"2": "GPL-2.0", "3": "GPL-3.0"}, "Lesser General": {"2.1": "LGPL-2.1", "3": "LGPL-3.0"}, "Affero General": {"3": "AGPL-3.0"}}
# Rules over the sentences of licence texts; statements and identifiers are rules of their own.
RULES = {
    "Apache-2.0": [["apache-2.0/licensed", "apache-2.0/compliance", "apache-2.0/as-is", "apache-2.0/language"], ["apache-2.0/licensed", "apache-2.0/compliance", "apache-2.0/as-is"], ["apache-2.0/licensed", "apache-2.0/compliance"], ["apache-2.0/compliance", "apache-2.0/as-is", "apache-2.0/language"], ["apache-2.0/compliance", "apache-2.0/as-is"], ["apache-2.0/text"]],
    "MIT": [["mit/title", "mit/grant", "mit/notice", "mit/as-is", "mit/liability"], ["mit/grant", "mit/notice", "mit/as-is", "mit/liability"], ["mit/title", "mit/grant", "mit/notice", "mit/as-is"], ["mit/grant", "mit/notice", "mit/as-is"], ["mit/title", "mit/grant", "mit/notice"], ["mit/grant", "mit/notice"], ["mit/grant"]],
    "MIT-0": [["mit-0/grant", "mit/as-is", "mit/liability"], ["mit-0/grant"]],
    "ISC": [["isc/grant", "isc/as-is"], ["isc/grant"]],
    "0BSD": [["0bsd/grant", "isc/as-is"], ["0bsd/grant"]],
    "GPL-2.0": [["gpl-2.0/text"]],
    "GPL-3.0": [["gpl-3.0/text"]],
    "LGPL-2.1": [["lgpl-2.1/text"]],
    "LGPL-3.0": [["lgpl-3.0/text"]],
    "AGPL-3.0": [["agpl-3.0/text"]],
    "BSD-4-Clause": [["bsd/redistribution", "bsd/source", "bsd/binary", "bsd/advertising", "bsd/no-endorsement"], ["bsd/redistribution", "bsd/source", "bsd/binary", "bsd/advertising"]],
    "BSD-3-Clause": [["bsd/redistribution", "bsd/source", "bsd/binary", "bsd/no-endorsement"], ["bsd/redistribution", "bsd/no-endorsement"]],
    "BSD-2-Clause": [["bsd/redistribution", "bsd/source", "bsd/binary"], ["bsd/redistribution"]],
    "MPL-2.0": [["mpl-2.0/subject", "mpl-2.0/copy"], ["mpl-2.0/subject"]],
    "EPL-2.0": [["epl-2.0/available"]],
    "EPL-1.0": [["epl-1.0/available"]],
    "BSL-1.0": [["bsl-1.0/text"]],
    "Zlib": [["zlib/as-is", "zlib/grant"], ["zlib/grant"]],
    "Unlicense": [["unlicense/free", "unlicense/anyone"], ["unlicense/free"]],
    "OpenSSL": [["openssl/acknowledgement"]],
    "NCSA": [["ncsa/grant", "mit/as-is"], ["ncsa/grant"]],
    "PostgreSQL": [["postgresql/grant"]],
    "LPPL-1.3c": [["lppl-1.3c/work"]],
    "CC0-1.0": [["cc0/waived"]],
    "Public-Domain": [["public-domain/dedicated"]],
    "Proprietary": [["proprietary/reserved", "proprietary/confidential"], ["proprietary/confidential"], ["proprietary/reserved"]],
}
#: Sentences that state no licence by themselves, and all identifiers that may stand between the sentences of a rule.
CONTEXT = frozenset(("mit/title", "gpl/no-warranty", "gpl/received", "mit/as-is", "mit/liability", "isc/as-is", "zlib/as-is", "mpl-2.0/copy", "unlicense/anyone", "apache-2.0/language", "bsd/source", "bsd/binary", "bsd/advertising", "bsd/no-endorsement"))
PASSED = frozenset(("mit/title", "proprietary/reserved"))
#: Words too common to tell whether a text may hold a licence sentence.
COMMON = frozenset("a all an and any are at be by file for if in is it may not of on one or program see software terms text the this to under use version was with without work you your".split())

_word = re.compile(r"[^\W_]+")
_end = re.compile(r"(?<=[.!?;:])[\s]+")
_tag = re.compile(r"^\W*(?:SPDX-License-Identifier|license|licence)\W*[:=]", re.I)
_joint = re.compile(r"[\s()\"',;]+")


def normal(sentence: str) -> str:
    """Small letters and digits in words parted by one blank: punctuation, case and spacing do not count."""
    return " ".join(_word.findall(sentence.lower()))


def openings(phrases) -> set[str]:
    """Every phrase's first words, of any number."""
    return {" ".join(w[:n]) for w in map(str.split, phrases) for n in range(1, len(w) + 1)}


def licence_names() -> dict[str, list[str]]:
    """Names of every licence, those of the Creative Commons made of their parts."""
    out = {k: [k, *v] for k, v in NAMES.items()}
    for kind, version in itertools.product(CREATIVE_KINDS, CREATIVE_VERSIONS):
        short, long = kind.upper(), "-".join(CREATIVE[k] for k in kind.split("-"))
        out[f"CC-{short}-{version}"] = [f"CC-{short}-{version}", f"CC {short} {version}", f"CC {short} {version} License", *(f"{c}{long} {version}{x}{y}" for c in ("Creative Commons ", "") for x in ("", " International", " Unported", " Generic") for y in ("", " License"))]
    return out


def notices() -> dict[str, list[str]]:
    """The notices that a GNU licence asks for, by licence."""
    out: dict[str, list[str]] = {}
    for kind, versions in FREE_SOFTWARE.items():
        for (version, licence), what, later in itertools.product(versions.items(), ("program", "library", "software", "file"), (", or (at your option) any later version", "")):
            terms = f"you can redistribute it and/or modify it under the terms of the GNU {kind} Public License as published by the Free Software Foundation"
            out.setdefault(licence, []).append(f"This {what} is free software: {terms}, {'either ' * bool(later)}version {version} of the License{later}")
    return out


def dedications() -> list[str]:
    """Statements that something is in the public domain."""
    whats = [w.removesuffix(" is") for w in STATEMENT[0] if w.startswith(("this ", "the ", "all ", "it "))]
    return [f"{what} {said} public domain" for what in whats for said in ("is", "is in the", "is dedicated to the", "is released into the", "is placed in the", "has been placed in the", "has been released into the", "has been dedicated to the")]


class Rules:
    """Sentence identifiers and the licence rules over them. Rules are tried longest first."""

    def __init__(self, sentences: dict[str, list[str]] = SENTENCES, rules: dict[str, list[list[str]]] = RULES):
        names = licence_names()
        self.ids = {normal(s): name for name, group in sentences.items() for s in group}
        self.ids = {normal(s): "public-domain/dedicated" for s in dedications()} | self.ids if "public-domain/dedicated" in sentences else self.ids
        self.ids |= {normal(s): f"{licence.lower()}/notice" for licence, group in notices().items() for s in group}
        self.names = {normal(n): f"{licence.lower()}/licensed" for licence, group in names.items() for n in group}
        self.starts = {" ".join(" ".join(choice).split()) for choice in itertools.product(*STATEMENT)}
        self.follows, self.between = set(FOLLOWS), set(BETWEEN)
        self.open_ids, self.open_names, self.open_starts, self.open_follows, self.open_between = map(openings, (self.ids, self.names, self.starts, self.follows, self.between))
        self.first_words = {s.split()[0] for s in self.starts}
        self.verbs = {s.split()[0] for s in STATEMENT[1]}
        self.longest_name = max(len(n.split()) for n in self.names)
        self.longest = max(len(s.split()) for s in self.starts)
        self.spdx = {f"{k}{ending}".lower(): f"{k.lower()}/spdx" for k in names for ending in SAME}
        every = {licence: [list(r) for r in group] for licence, group in rules.items()}
        for licence in names:
            every.setdefault(licence, []).extend([[f"{licence.lower()}/licensed"], [f"{licence.lower()}/spdx"]])
        for licence in notices():
            every[licence] += [[f"{licence.lower()}/notice", "gpl/no-warranty", "gpl/received"], [f"{licence.lower()}/notice", "gpl/no-warranty"], [f"{licence.lower()}/notice"]]
        self.rules = sorted(((tuple(r), licence) for licence, group in every.items() for r in group), key=lambda x: (-len(x[0]), x[1], x[0]))
        self.by_first: dict[str, list] = {}
        for rule in self.rules:
            self.by_first.setdefault(rule[0][0], []).append(rule)
        self.trigger = sorted(self.cover())

    def may_match(self, text: str) -> bool:
        """False only if no line of the text is a known sentence, statement, tag or expression."""
        low = text.lower()
        return any(w in low for w in self.trigger) or " OR " in text or " AND " in text

    def cover(self) -> set[str]:
        """Words of which every known sentence, every opening of a statement and every tag has one; a text without any of
        them needs no further look."""
        left = [set(s.split()) for s in [*self.ids, *self.starts]]
        out = {"spdx", "license", "licence"}
        while left:
            counts = Counter(w for words in left for w in words if w not in COMMON and len(w) > 1) or Counter(w for words in left for w in words)
            best = max(counts, key=lambda w: (counts[w], len(w), w))
            out.add(best)
            left = [words for words in left if not any(best in w for w in words)]
        return out

    def stated(self, words: list[str], at: int, loose: bool = False) -> tuple[list[str] | None, bool]:
        """Identifiers of the licence names from word ``at`` on, None if there are none; and whether more words may complete
        them. What follows the names is one of FOLLOWS or, if ``loose``, anything, but see AFTER_WORD."""
        rest = " ".join(words[at:])
        if not rest:
            return None, True
        is_open = rest in self.open_names
        for end in range(min(len(words), at + self.longest_name), at, -1):
            name = self.names.get(" ".join(words[at:end]))
            if not name:
                continue
            after = " ".join(words[end:])
            if not after or after in self.follows:
                return [name], True
            is_open |= after in self.open_follows or after in self.open_between
            for n in range(1, 3):
                if " ".join(words[end : end + n]) in self.between:
                    more, going = self.stated(words, end + n, loose)
                    is_open |= going
                    if more:
                        return [name, *more], is_open
            if loose and (end - at > 1 or words[end] in AFTER_WORD):
                return [name], is_open
        return None, is_open

    def reading(self, joined: str) -> tuple[list[str] | None, bool]:
        """Identifiers of a normalised sentence, and whether it may be the opening of a longer one."""
        found, is_open = self.ids.get(joined), joined in self.open_ids
        found = [found] if found else None
        words = joined.split()
        if words[0] in self.first_words and len(words) < 60:
            is_open |= joined in self.open_starts
            for n in range(1, min(self.longest, len(words)) + 1):
                if " ".join(words[:n]) in self.starts:
                    stated, going = self.stated(words, n)
                    found, is_open = found or stated, is_open or going
        return found, is_open

    def within(self, words: list[str]) -> list[str] | None:
        """Identifiers that statements within a sentence name; such a statement stands in one line."""
        found = []
        if self.verbs.isdisjoint(words):
            return None
        for i, word in enumerate(words):
            if word not in self.verbs or not DENIED.isdisjoint(words[max(0, i - 3) : i]):
                continue
            most = []
            for n in range(2, min(self.longest, len(words) - i) + 1):
                if " ".join(words[i : i + n]) in self.starts:
                    most = self.stated(words, i + n, loose=True)[0] or most
            found += [x for x in most if x not in found]
        return found or None

    def expression(self, line: str, start: int) -> list[tuple[str, int, int]]:
        """The identifiers of a line that is a tag with an identifier or an expression of several, or a bare expression. Of a
        tag's expression those that are known count; a bare one counts only if all are."""
        tag = _tag.match(line)
        body, offset = (line[tag.end() :], tag.end()) if tag else (line, 0)
        if len(body) > 400 or not tag and " OR " not in body and " AND " not in body:
            return []
        out, at, expected = [], 0, True
        for word in _joint.split(body.strip().rstrip("*/#->").rstrip(".")):
            if not word:
                continue
            at = body.index(word, at)
            if word in ("OR", "AND"):
                if expected:
                    return []
                expected = True
            elif word == "WITH" or out and out[-1] is None:
                out.append(None if word == "WITH" else ())
            elif not expected or not tag and word.lower() not in self.spdx:
                return []
            elif word.lower() not in self.spdx:
                out.append(())
                expected = False
            else:
                out.append((self.spdx[word.lower()], start + offset + at, start + offset + at + len(word)))
                expected = False
            at += len(word)
        return [] if expected else [x for x in out if x]

    def sentences(self, text: str) -> list[tuple[str, int, int]]:
        """Known sentences of a text in order: (identifier, start, end), code points.

        A line is looked up whole, then by its sentences, then by adjacent sentences together, as known sentences may
        hold a full stop; a sentence that is broken over two lines is found as well. Statements may stand within the sentences of a line.
        """
        out, at, parts = [], 0, []
        for line in text.split("\n"):
            tagged = self.expression(line, at)
            if tagged:
                parts.append((at, at + len(line), tagged))
            else:
                cuts = [0, *(m.end() for m in _end.finditer(line)), len(line)]
                parts += [(at + a, at + b, None) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]
            at += len(line) + 1
        words = [normal(text[a:b]) for a, b, _ in parts]
        i = 0
        while i < len(parts):
            if parts[i][2]:
                out += parts[i][2]
                i += 1
                continue
            joined, found, last = "", None, i
            for j in range(i, len(parts)):
                if parts[j][2] or not words[i]:
                    break
                joined = f"{joined} {words[j]}".strip()
                known, is_open = self.reading(joined)
                if known and words[j]:
                    found, last = known, j
                if not is_open:
                    break
            found = found or self.within(words[i].split())
            if not found:
                i += 1
                continue
            a, b = parts[i][0], parts[last][1]
            piece = text[a:b]
            out += [(name, a + len(piece) - len(piece.lstrip()), a + len(piece.rstrip())) for name in found]
            i = last + 1
        return out

    def match(self, text: str) -> list[tuple[str, str, int, int]]:
        """(licence, identifiers joined by +, start, end) of every rule found, in text order, without overlap."""
        if not self.may_match(text):
            return []
        found, out, i = self.sentences(text), [], 0
        names, after = [f[0] for f in found], [len(found)] * (len(found) + 1)
        for j in range(len(found) - 1, -1, -1):
            after[j] = after[j + 1] if names[j] in PASSED else j
        while i < len(found):
            for rule, licence in self.by_first.get(names[i], ()):
                end = self.end_of(rule, names, after, i)
                if end:
                    out.append((licence, "+".join(rule), found[i][1], found[end - 1][2]))
                    i = end
                    break
            else:
                i += 1
        return out

    @staticmethod
    def end_of(rule: tuple[str, ...], names: list[str], after: list[int], i: int) -> int:
        """Where ``rule`` ends if it begins at ``i``, else 0; ``after`` has the next identifier from each on that is not in PASSED."""
        for k, name in enumerate(rule):
            if k and (i == len(names) or names[i] != name):
                i = after[i]
            if i == len(names) or names[i] != name:
                return 0
            i += 1
        return i


MATCHES = "array<struct<licence:string,rule:string,start:int,end:int>>"


def scan(docs: DataFrame, rules: Rules | None = None) -> DataFrame:
    """Licences stated in every whole text: doc_id, n_licences, licences (sorted names joined by a comma), matches.

    "All rights reserved" counts as the licence Proprietary unless it stands within another licence's rule. A text without
    a licence, an empty and a null one give 0, an empty string and an empty list. A null doc_id stays null; repeated rows are scanned each; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(rules or Rules())
    kind = pa.list_(pa.struct([("licence", pa.string()), ("rule", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in itertools.chain.from_iterable(map(pieces, batches)):
            found = [known.match(t) if t else [] for t in batch.column(1).to_pylist()]
            names = [sorted({m[0] for m in ms}) for ms in found]
            matches = [[dict(zip(("licence", "rule", "start", "end"), m, strict=True)) for m in ms] for ms in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array([len(n) for n in names], np.int64)), pa.array([",".join(n) for n in names], pa.string()), pa.array(matches, kind)],
                ["doc_id", "n_licences", "licences", "matches"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id bigint, n_licences bigint, licences string, matches {MATCHES}")
