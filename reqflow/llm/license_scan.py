"""License scans: ordered signature rules on word sequences, all in Spark expressions.

A text is lower-cased (A-Z) and reduced to its words with one blank between
them; rules are regular expressions over these words, so line breaks, comment
signs and punctuation inside a license line don't matter.  Each rule names one
word that any match of it holds; a rule is tried on a document only if that word
is among the document's words.  In the string that rules are matched against, each word is followed by
its number, so a match tells where it stands and the work is linear in text and detections.  A detection is dropped if one of the same or a
better priority covers its whole interval (of equal intervals, the earlier rule
stays): by running maxima over a document's detections in order.  Base phrases always keep their labels.

Defined results: null and empty texts have no words, no detections and score 0;
long texts are scanned whole; repeated rows are scanned alike; an empty table
gives an empty table; extra columns are never read.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reqflow.llm.common import ascii_lower, keyed

#: What is not part of a word.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
BASE_KEYWORDS = {"cc by": "cc", "general public license": "general", "all rights reserved": "reserved"}

#: Confidence by priority (1 is best); base phrases alone have the last.
CONFIDENCE = {1: 1.0, 2: 0.95, 3: 0.8, 4: 0.6, 5: 0.4}


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: str
    priority: int
    base: bool = False


# Label, keyword, name as a pattern over words, SPDX identifier as a pattern, words of its address (or None).
FAMILIES = (
    ("apache-2.0", "apache", r"apache (?:software )?licen[cs]e(?: version)?(?: v?2)?(?: 0)?", r"apache 2 0", r"apache org licenses license 2 0"),
    ("apache-1.1", "apache", r"apache (?:software )?licen[cs]e(?: version)? v?1 1", r"apache 1 1", r"apache org licenses license 1 1"),
    ("mit", "mit", r"mit(?: x11| expat)? licen[cs]e", r"mit", r"opensource org licenses? mit"),
    ("mit-0", "mit", r"mit (?:no attribution|0) licen[cs]e", r"mit 0", r"opensource org licenses? mit 0"),
    ("bsd-2-clause", "bsd", r"(?:simplified|2 clause|two clause|freebsd) bsd(?: style)? licen[cs]e", r"bsd 2 clause", r"opensource org licenses? bsd 2 clause"),
    ("bsd-3-clause", "bsd", r"(?:new|modified|revised|3 clause|three clause) bsd(?: style)? licen[cs]e", r"bsd 3 clause", r"opensource org licenses? bsd 3 clause"),
    ("bsd-4-clause", "bsd", r"(?:original|4 clause|four clause) bsd(?: style)? licen[cs]e", r"bsd 4 clause", None),
    ("0bsd", "bsd", r"(?:zero clause|0 clause) bsd licen[cs]e", r"0bsd", r"opensource org licenses? 0bsd"),
    ("isc", "isc", r"isc licen[cs]e", r"isc", r"opensource org licenses? isc"),
    ("gpl-1.0", "gnu", r"gnu (?:gpl|general public licen[cs]e)(?: version)? v?1(?: 0)?", r"gpl 1 0(?: only| or later)?", r"gnu org licenses gpl 1 0"),
    ("gpl-2.0", "gnu", r"gnu (?:gpl|general public licen[cs]e)(?: version)? v?2(?: 0)?", r"gpl 2 0(?: only| or later)?", r"gnu org licenses gpl 2 0"),
    ("gpl-3.0", "gnu", r"gnu (?:gpl|general public licen[cs]e)(?: version)? v?3(?: 0)?", r"gpl 3 0(?: only| or later)?", r"gnu org licenses gpl 3 0"),
    ("lgpl-2.0", "library", r"gnu library (?:gpl|general public licen[cs]e)(?: version)?(?: v?2)?(?: 0)?", r"lgpl 2 0(?: only| or later)?", None),
    ("lgpl-2.1", "lesser", r"gnu lesser (?:gpl|general public licen[cs]e)(?: version)? v?2 1", r"lgpl 2 1(?: only| or later)?", None),
    ("lgpl-3.0", "lesser", r"gnu lesser (?:gpl|general public licen[cs]e)(?: version)? v?3(?: 0)?", r"lgpl 3 0(?: only| or later)?", None),
    ("agpl-3.0", "affero", r"gnu affero (?:gpl|general public licen[cs]e)(?: version)?(?: v?3)?(?: 0)?", r"agpl 3 0", None),
    ("fdl-1.3", "documentation", r"gnu free documentation licen[cs]e(?: version)?(?: 1 [123])?", r"gfdl 1 3", None),
    ("mpl-1.1", "mozilla", r"mozilla public licen[cs]e(?: version)? v?1 1", r"mpl 1 1", r"mozilla org mpl mpl 1 1"),
    ("mpl-2.0", "mozilla", r"mozilla public licen[cs]e(?: version)? v?2(?: 0)?", r"mpl 2 0", r"mozilla org (?:en us )?mpl 2 0"),
    ("epl-1.0", "eclipse", r"eclipse public licen[cs]e(?: version)? v?1(?: 0)?", r"epl 1 0", r"eclipse org legal epl v10"),
    ("epl-2.0", "eclipse", r"eclipse public licen[cs]e(?: version)? v?2(?: 0)?", r"epl 2 0", r"eclipse org legal epl (?:2 0|v20)"),
    ("cddl-1.0", "distribution", r"common development and distribution licen[cs]e(?: version)?(?: 1 0)?", r"cddl 1 0", None),
    ("cpl-1.0", "common", r"common public licen[cs]e(?: version)?(?: 1 0)?", r"cpl 1 0", None),
    ("artistic-1.0", "artistic", r"artistic licen[cs]e(?: version)? 1(?: 0)?", r"artistic 1 0", None),
    ("artistic-2.0", "artistic", r"artistic licen[cs]e(?: version)? 2(?: 0)?", r"artistic 2 0", r"opensource org licenses? artistic 2 0"),
    ("bsl-1.0", "boost", r"boost software licen[cs]e(?: version)?(?: 1 0)?", r"bsl 1 0", r"boost org license 1 0"),
    ("busl-1.1", "business", r"business source licen[cs]e(?: version)?(?: 1 1)?", r"busl 1 1", None),
    ("sspl-1.0", "server", r"server side public licen[cs]e(?: version)?(?: 1)?(?: 0)?", r"sspl 1 0", None),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[cs]e", r"zlib", r"opensource org licenses? zlib"),
    ("unlicense", "unlicense", r"(?:the )?unlicense", r"unlicense", r"unlicense org"),
    ("wtfpl", "wtfpl", r"wtfpl(?: version 2)?", r"wtfpl", r"wtfpl net"),
    ("cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?", r"cc0 1 0", None),
    ("cc-by", "creative", r"creative commons attribution(?: [1-4] [05])?(?: international| unported| generic)? licen[cs]e", r"cc by [1-4] [05]", None),
    ("cc-by-sa", "creative", r"creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[cs]e)?", r"cc by sa [1-4] [05]", None),
    ("cc-by-nc", "creative", r"creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[cs]e)?", r"cc by nc [1-4] [05]", None),
    ("cc-by-nd", "creative", r"creative commons attribution no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?(?: licen[cs]e)?", r"cc by nd [1-4] [05]", None),
    ("cc-by-nc-sa", "creative", r"creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: licen[cs]e)?", r"cc by nc sa [1-4] [05]", None),
    ("cc-by-nc-nd", "creative", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: [1-4] [05])?(?: licen[cs]e)?", r"cc by nc nd [1-4] [05]", None),
    ("odbl", "database", r"open database licen[cs]e", r"odbl 1 0", None),
    ("odc-by", "data", r"open data commons attribution licen[cs]e", r"odc by 1 0", None),
    ("pddl", "dedication", r"public domain dedication and licen[cs]e", r"pddl 1 0", None),
    ("ofl-1.1", "font", r"sil open font licen[cs]e(?: version)?(?: 1 1)?", r"ofl 1 1", None),
    ("eupl-1.2", "european", r"european union public licen[cs]e(?: version)?(?: v?1 2)?", r"eupl 1 2", None),
    ("ms-pl", "microsoft", r"microsoft public licen[cs]e", r"ms pl", None),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[cs]e", r"ms rl", None),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa open source licen[cs]e", r"ncsa", None),
    ("python-2.0", "python", r"python software foundation licen[cs]e(?: version)?(?: 2)?", r"python 2 0", None),
    ("php-3.01", "php", r"php licen[cs]e(?: version)?(?: 3 01)?", r"php 3 01", None),
    ("ruby", "ruby", r"ruby licen[cs]e", r"ruby", None),
    ("postgresql", "postgresql", r"postgresql licen[cs]e", r"postgresql", None),
    ("openssl", "openssl", r"openssl(?: ssleay)? licen[cs]e", r"openssl", None),
    ("osl-3.0", "open", r"open software licen[cs]e(?: version)?(?: 3 0)?", r"osl 3 0", None),
    ("afl-3.0", "academic", r"academic free licen[cs]e(?: version)?(?: 3 0)?", r"afl 3 0", None),
    ("upl-1.0", "universal", r"universal permissive licen[cs]e(?: version)?(?: 1 0)?", r"upl 1 0", None),
    ("openrail", "responsible", r"(?:open )?responsible ai licen[cs]e", r"openrail", None),
    ("llama-community", "llama", r"llama (?:[234] )?community licen[cs]e(?: agreement)?", r"llama [234]", None),
)

# Statements that stand for themselves: label, keyword, pattern, priority.
STATEMENTS = (
    ("mit", "hereby", r"permission is hereby granted free of charge to any person obtaining a copy", 2),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted", 2),
    ("isc", "purpose", r"permission to use copy modify and or distribute this software for any purpose with or without fee", 2),
    ("zlib", "misrepresented", r"the origin of this software must not be misrepresented", 2),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain", 2),
    ("wtfpl", "wtf", r"do what the wtf you want to public license", 2),
    ("bsl-1.0", "boost", r"distributed under the boost software license", 2),
    ("gpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public license", 2),
    ("gpl", "gpl", r"(?:gnu )?gpl(?: ?v[123]| version [123]| [123] 0)?", 4),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl(?: ?v[23]| version [23]| [23] [01])?", 4),
    ("agpl", "agpl", r"(?:gnu )?agpl(?: ?v3| version 3| 3 0)?", 4),
    ("gpl-2.0", "gplv2", r"gplv2", 3),
    ("gpl-3.0", "gplv3", r"gplv3", 3),
    ("lgpl-2.1", "lgplv2", r"lgplv2(?: 1)?", 3),
    ("lgpl-3.0", "lgplv3", r"lgplv3", 3),
    ("gpl", "gplv1", r"(?:gnu )?gplv1", 4),
    ("agpl", "agplv3", r"(?:gnu )?agplv3", 4),
    ("mpl-2.0", "mpl", r"mpl 2 0", 4),
    ("cc-by", "cc", r"cc by(?: [1-4] [05])?", 4),
    ("cc-by-sa", "cc", r"cc by sa(?: [1-4] [05])?", 3),
    ("cc-by-nc", "cc", r"cc by nc(?: [1-4] [05])?", 3),
    ("cc-by-nd", "cc", r"cc by nd(?: [1-4] [05])?", 3),
    ("cc-by-nc-sa", "cc", r"cc by nc sa(?: [1-4] [05])?", 3),
    ("cc-by-nc-nd", "cc", r"cc by nc nd(?: [1-4] [05])?", 3),
    ("cc", "creativecommons", r"creativecommons org licenses", 4),
    ("cc-by", "creativecommons", r"creativecommons org licenses by [1-4] [05]", 2),
    ("cc-by-sa", "creativecommons", r"creativecommons org licenses by sa [1-4] [05]", 2),
    ("cc-by-nc", "creativecommons", r"creativecommons org licenses by nc [1-4] [05]", 2),
    ("cc-by-nd", "creativecommons", r"creativecommons org licenses by nd [1-4] [05]", 2),
    ("cc0-1.0", "creativecommons", r"creativecommons org publicdomain zero 1 0", 2),
    ("cc", "creative", r"creative commons licen[cs]e", 4),
    ("public-domain", "domain", r"(?:released|placed|dedicated|in) (?:in|into|to|under )?(?:the )?public domain", 3),
    ("proprietary", "proprietary", r"(?:proprietary and confidential|confidential and proprietary)", 3),
    ("proprietary", "unauthorized", r"unauthorized (?:copying|reproduction|use) (?:of this file )?(?:is )?(?:strictly )?prohibited", 3),
    ("copyright", "copyright", r"copyright(?: c)?(?: [12][0-9]{3})+", 4),
    ("no-warranty", "warranty", r"without warranty of any kind", 4),
    ("no-warranty", "warranties", r"without warranties or conditions of any kind", 4),
)


#: Some words, as few as will do.
_W = r"(?:[^\x01\x20]+ ){1,12}?"

# Whole notices, headers and clauses of license texts: label, keyword, pattern, priority.
NOTICES = (
    ("apache-2.0", "compliance", r"you may not use this file except in compliance with the licen[cs]e", 2),
    ("apache-2.0", "applicable", r"unless required by applicable law or agreed to in writing software distributed under the licen[cs]e is distributed on an as is basis", 2),
    ("apache-2.0", "perpetual", r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|patent) licen[cs]e", 2),
    ("apache-2.0", "contributor", r"licensed to the apache software foundation asf under one or more contributor licen[cs]e agreements", 1),
    ("apache-1.1", "apache", r"this product includes software developed by the apache software foundation", 3),
    ("apache-2.0-llvm", "llvm", r"apache licen[cs]e v2 0 with llvm exceptions?", 1),
    ("mit", "substantial", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", 2),
    ("mit", "noninfringement", r"including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement", 3),
    ("mit", "holders", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability", 3),
    ("mit", "restriction", r"to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies", 2),
    ("bsd", "retain", r"redistributions of source code must retain the above copyright notice", 2),
    ("bsd", "reproduce", r"redistributions in binary form must reproduce the above copyright notice", 2),
    ("bsd-3-clause", "endorse", rf"neither the names? of {_W}nor the names of (?:its|their|any) contributors may be used to endorse or promote products derived from this software", 1),
    ("bsd-4-clause", "advertising", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment", 1),
    ("bsd", "consequential", r"in no event shall the (?:regents|copyright (?:holders?|owner)|author)(?: or contributors)? be liable for any direct indirect incidental special exemplary or consequential damages", 3),
    ("isc", "disclaims", r"the software is provided as is and the author disclaims all warranties with regard to this software", 2),
    ("zlib", "altered", r"altered source versions must be plainly marked as such", 2),
    ("zlib", "removed", r"this notice may not be removed or altered from any source distribution", 2),
    ("zlib", "applications", r"permission is granted to anyone to use this software for any purpose including commercial applications", 2),
    ("gpl-2.0-or-later", "option", r"gnu general public licen[cs]e as published by the free software foundation either version 2 of the licen[cs]e or at your option any later version", 1),
    ("gpl-3.0-or-later", "option", r"gnu general public licen[cs]e as published by the free software foundation either version 3 of the licen[cs]e or at your option any later version", 1),
    ("lgpl-2.1-or-later", "option", r"gnu lesser general public licen[cs]e as published by the free software foundation either version 2 1 of the licen[cs]e or at your option any later version", 1),
    ("lgpl-3.0-or-later", "option", r"gnu lesser general public licen[cs]e as published by the free software foundation either version 3 of the licen[cs]e or at your option any later version", 1),
    ("agpl-3.0-or-later", "option", r"gnu affero general public licen[cs]e as published by the free software foundation either version 3 of the licen[cs]e or at your option any later version", 1),
    ("gpl-2.0", "foundation", r"gnu general public licen[cs]e version 2 as published by the free software foundation", 1),
    ("gpl-2.0", "1991", r"gnu general public licen[cs]e version 2 june 1991", 1),
    ("gpl-3.0", "2007", r"gnu general public licen[cs]e version 3 29 june 2007", 1),
    ("lgpl-2.1", "1999", r"gnu lesser general public licen[cs]e version 2 1 february 1999", 1),
    ("lgpl-3.0", "2007", r"gnu lesser general public licen[cs]e version 3 29 june 2007", 1),
    ("agpl-3.0", "2007", r"gnu affero general public licen[cs]e version 3 19 november 2007", 1),
    ("gpl", "hope", r"distributed in the hope that it will be useful but without any warranty", 3),
    ("gpl", "received", r"you should have received a copy of the gnu general public licen[cs]e", 2),
    ("lgpl", "received", r"you should have received a copy of the gnu (?:lesser|library) general public licen[cs]e", 2),
    ("agpl", "received", r"you should have received a copy of the gnu affero general public licen[cs]e", 2),
    ("gpl", "verbatim", r"everyone is permitted to copy and distribute verbatim copies of this licen[cs]e document but changing it is not allowed", 3),
    ("gpl-2.0", "freedom", r"the licen[cs]es for most software are designed to take away your freedom to share and change it", 2),
    ("gpl-3.0", "copyleft", r"the gnu general public licen[cs]e is a free copyleft licen[cs]e for software and other kinds of works", 1),
    ("agpl-3.0", "interacting", r"all users interacting with it remotely through a computer network", 2),
    ("gpl-classpath", "classpath", r"(?:gnu )?classpath (?:linking )?exception", 2),
    ("gpl-gcc-exception", "runtime", r"gcc runtime library exception(?: version)?(?: 3 1)?", 2),
    ("gpl-linux-syscall", "syscall", r"linux syscall note", 2),
    ("fdl", "invariant", r"with no invariant sections no front cover texts and no back cover texts", 2),
    ("fsfap", "royalty", r"copying and distribution of this file with or without modification are permitted in any medium without royalty", 1),
    ("fsful", "unlimited", r"the free software foundation gives unlimited permission to copy and or distribute it", 1),
    ("mpl-2.0", "mozilla", r"this source code form is subject to the terms of the mozilla public licen[cs]e v ?2 0", 1),
    ("mpl-2.0", "mpl", r"if a copy of the mpl was not distributed with this file you can obtain one at", 2),
    ("mpl-1.1", "mozilla", r"the contents of this file are subject to the mozilla public licen[cs]e version 1 1", 1),
    ("epl-1.0", "accompanying", r"the accompanying materials are made available under the terms of the eclipse public licen[cs]e v ?1 0", 1),
    ("epl-2.0", "accompanying", r"the accompanying materials are made available under the terms of the eclipse public licen[cs]e (?:v ?)?2 0", 1),
    ("cddl-1.0", "subject", r"the contents of this file are subject to the terms of the common development and distribution licen[cs]e", 1),
    ("bsl-1.0", "organization", r"to any person or organization obtaining a copy of the software and accompanying documentation covered by this licen[cs]e", 1),
    ("unlicense", "compile", r"anyone is free to copy modify publish use compile sell or distribute this software", 2),
    ("unlicense", "heirs", r"detriment of our heirs and successors", 2),
    ("unlicense", "relinquishment", r"an overt act of relinquishment in perpetuity of all present and future rights", 2),
    ("wtfpl", "fuck", r"do what the fuck you want to public licen[cs]e", 1),
    ("cc0-1.0", "waived", rf"to the extent possible under law {_W}(?:has|have) waived all copyright and related or neighbou?ring rights", 1),
    ("cc-by", "work", r"this work is licensed under a creative commons attribution(?: [1-4] [05])?(?: international| unported| generic)? licen[cs]e", 1),
    ("cc-by-sa", "work", r"this work is licensed under a creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported| generic)? licen[cs]e", 1),
    ("cc-by-nc", "work", r"this work is licensed under a creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported| generic)? licen[cs]e", 1),
    ("cc", "redistribute", r"you are free to share copy and redistribute the material in any medium or format", 3),
    ("cc-by", "credit", r"you must give appropriate credit provide a link to the licen[cs]e and indicate if changes were made", 3),
    ("cc-by-sa", "remix", r"if you remix transform or build upon the material you must distribute your contributions under the same licen[cs]e as the original", 2),
    ("cc-by-nd", "remix", r"if you remix transform or build upon the material you may not distribute the modified material", 2),
    ("cc-by-nc", "material", r"you may not use the material for commercial purposes", 2),
    ("odbl", "database", r"this [^\x01\x20]+ database is made available under the open database licen[cs]e|this database is made available under the open database licen[cs]e", 1),
    ("dbcl", "contents", r"any rights in individual contents of the database are licensed under the database contents licen[cs]e", 1),
    ("ofl-1.1", "font", r"this font software is licensed under the sil open font licen[cs]e version 1 1", 1),
    ("artistic-1.0", "intent", r"the intent of this document is to state the conditions under which a package may be copied", 1),
    ("perl", "perl", r"(?:you can|you may) redistribute it and or modify it under the same terms as perl(?: itself)?", 1),
    ("python-2.0", "psf", r"psf (?:is making python available to licensee on an as is basis|hereby grants licensee a nonexclusive royalty free world wide licen[cs]e)", 1),
    ("php-3.01", "php", r"this product includes php software freely available from", 1),
    ("openssl", "toolkit", r"this product includes software developed by the openssl project for use in the openssl toolkit", 1),
    ("hpnd", "historical", r"historical permission notice and disclaimer", 2),
    ("x11", "consortium", r"the name of the x consortium shall not be used in advertising", 1),
    ("libpng", "libpng", r"libpng (?:version [12] )?licen[cs]e(?: version [12])?", 3),
    ("ijg", "jpeg", r"based in part on the work of the independent jpeg group", 1),
    ("curl", "curl", r"curl licen[cs]e", 3),
    ("vim", "vim", r"vim licen[cs]e", 3),
    ("beerware", "beer", r"the beer ware licen[cs]e|you can buy me a beer in return", 2),
    ("beerware", "beerware", r"beerware licen[cs]e", 2),
    ("unicode", "unicode", r"unicode (?:inc )?licen[cs]e agreement(?: data files and software)?", 2),
    ("w3c", "w3c", r"w3c (?:software|document)(?: and document)?(?: notice and)? licen[cs]e", 2),
    ("nasa-1.3", "nasa", r"nasa open source agreement(?: version)?(?: 1 3)?", 2),
    ("ibm-pl", "ibm", r"ibm public licen[cs]e(?: version)?(?: 1 0)?", 2),
    ("lucent", "lucent", r"lucent public licen[cs]e(?: version)?(?: 1 02)?", 2),
    ("apsl-2.0", "apple", r"apple public source licen[cs]e(?: version)?(?: 2 0)?", 2),
    ("sleepycat", "sleepycat", r"sleepycat (?:public |software )?licen[cs]e", 2),
    ("npl-1.1", "netscape", r"netscape public licen[cs]e(?: version)?(?: 1 [01])?", 2),
    ("zpl-2.1", "zope", r"zope public licen[cs]e(?: version)?(?: 2 1)?", 2),
    ("efl-2.0", "eiffel", r"eiffel forum licen[cs]e(?: version)?(?: 2)?", 2),
    ("cpal-1.0", "attribution", r"common public attribution licen[cs]e(?: version)?(?: 1 0)?", 2),
    ("rpl-1.5", "reciprocal", r"reciprocal public licen[cs]e(?: version)?(?: 1 5)?", 2),
    ("cecill", "cecill", r"cecill(?: [bc])?(?: version)?(?: 2 [01])?(?: licen[cs]e)?", 3),
    ("cecill", "logiciel", r"ce logiciel est r\u00E9gi par la licence cecill", 1),
    ("eupl-1.2", "eupl", r"licensed under the eupl(?: version)?(?: v?1 [012])?", 2),
    ("mulan-2.0", "mulan", r"mulan (?:psl|permissive software licen[cs]e)(?: ?v2| version 2)?", 2),
    ("busl-1.1", "production", r"the right to copy modify create derivative works redistribute and make non production use of the licensed work", 1),
    ("sspl-1.0", "functionality", r"if you make the functionality of the program or a modified version available to third parties as a service", 1),
    ("elastic-2.0", "elastic", r"elastic licen[cs]e(?: version)?(?: v?2(?: 0)?)?", 3),
    ("elastic-2.0", "hosted", r"you may not provide the software to third parties as a hosted or managed service", 1),
    ("commons-clause", "commons", r"commons clause(?: licen[cs]e condition)?(?: v1 0)?", 2),
    ("polyform", "polyform", r"polyform (?:noncommercial|small business|shield|perimeter|strict|free trial|internal use) licen[cs]e", 2),
    ("llama-community", "llama", r"built with (?:meta )?llama", 3),
    ("llama-community", "meta", r"meta llama [23] is licensed under the meta llama [23] community licen[cs]e", 1),
    ("gemma", "gemma", r"gemma terms of use", 2),
    ("openrail", "bigscience", r"bigscience (?:open )?rail(?: m)?(?: licen[cs]e)?", 2),
    ("openrail", "creativeml", r"creativeml open ?rail(?: ?m)?(?: licen[cs]e)?", 2),
    ("ogl-uk", "government", r"open government licen[cs]e(?: v?[123](?: 0)?)?", 2),
    ("ogl-uk", "sector", r"contains public sector information licensed under", 2),
    ("etalab", "ouverte", r"licence ouverte(?: open licence)?(?: version)?(?: 2 0)?", 2),
    ("dl-de", "datenlizenz", r"datenlizenz deutschland(?: namensnennung| zero)?(?: version)?(?: 2 0)?", 2),
    ("public-domain", "protection", r"(?:is )?not subject to copyright protection in the united states", 2),
    ("public-domain", "105", r"pursuant to title 17 section 105 of the united states code", 1),
    ("public-domain", "copyrighted", r"this (?:work|software|file|document) is not copyrighted", 3),
    ("proprietary", "reproduced", r"no part of this (?:publication|book|document|work|website) may be reproduced", 2),
    ("proprietary", "internal", r"for internal use only", 3),
    ("proprietary", "information", r"this (?:software|document|file) is the confidential and proprietary information of", 2),
    ("proprietary", "secrets", r"contains trade secrets", 3),
    ("proprietary", "written", r"(?:copied|reproduced|distributed|republished|used) (?:in any form )?without (?:the )?(?:prior |express |explicit )*written (?:permission|consent)", 2),
    ("eula", "agree", r"by (?:using|installing|downloading|accessing) (?:this|the) (?:software|product|program|site|website) you agree to", 3),
    ("eula", "agreement", r"end user licen[cs]e agreement", 2),
    ("eula", "revocable", r"limited non exclusive non transferable revocable licen[cs]e", 2),
    ("evaluation", "evaluation", r"for evaluation (?:purposes )?only", 3),
    ("non-commercial", "commercial", r"(?:for non commercial use only|not for commercial use|personal and non commercial use only)", 3),
    ("non-commercial", "noncommercial", r"(?:for|personal and) noncommercial use only", 3),
    ("reserved", "vorbehalten", r"alle rechte vorbehalten", 4),
    ("reserved", "droits", r"tous droits r\u00E9serv\u00E9s", 4),
    ("reserved", "reservados", r"todos los derechos reservados", 4),
    ("reserved", "riservati", r"tutti i diritti riservati", 4),
    ("license-file", "copying", r"see (?:the )?(?:file )?copying(?: lesser| txt| md)? for (?:more )?(?:copying permission|details|information)", 4),
    ("license-file", "license", r"see (?:the )?(?:file )?license(?: txt| md)? (?:file )?(?:in the project root )?for (?:full |more )?(?:licen[cs]e )?(?:details|information)", 4),
)


def build_rules() -> tuple[Rule, ...]:
    """Every family's forms - identifier, grant, address, name, name with a nearby notice - then statements, notices and base phrases."""
    rules = []
    grant = r"(?:licen[cs]ed|released|distributed|published|available|provided|covered|redistributed|shared) (?:for use )?(?:under|by|subject to|according to) (?:the )?(?:terms (?:and conditions )?of )?(?:the |a |an )?"
    for label, keyword, name, spdx, address in FAMILIES:
        rules.append(Rule(label, "spdx", rf"spdx licen[cs]e identifier {spdx}", 1))
        rules.append(Rule(label, keyword, grant + name, 2))
        rules.append(Rule(label, keyword, rf"(?:use|copying|distribution) (?:of this (?:file|software|work) )?is governed by (?:the |a )?{name}", 2))
        rules.append(Rule(label, keyword, rf"see (?:the )?{name} for (?:more )?details", 3))
        rules.append(Rule(label, keyword, name, 3))
        if address:
            rules.append(Rule(label, address.split(" ")[0], rf"(?:https? )?(?:www )?{address}", 2))
    rules += [Rule(*s) for s in STATEMENTS + NOTICES]
    rules += [Rule(label, BASE_KEYWORDS[phrase], phrase, 5, True) for phrase, label in BASE.items()]
    return tuple(rules)


RULES = build_rules()


#: What follows a word in the string that rules are matched against: a mark and the word's number.
MARK = "\x01"
_NUMBER = r"\x01[0-9]++"


def over_numbered(pattern: str) -> str:
    """A pattern over words with blanks between, for words that are followed by their numbers."""
    return rf"(?<= )(?:{pattern.replace(' ', f'(?:{_NUMBER} )')}){_NUMBER}(?= )"


def rule_array(rules: tuple[Rule, ...]) -> Column:
    """The ordered rules as one literal."""
    made = [{"rule": i, "label": r.label, "keyword": r.keyword, "pattern": over_numbered(r.pattern), "priority": r.priority, "base": r.base} for i, r in enumerate(rules)]
    return F.from_json(F.lit(json.dumps(made)), "array<struct<rule:int,label:string,keyword:string,pattern:string,priority:int,base:boolean>>")


def _hits(numbered: Column, rule: Column) -> Column:
    """Detections of one rule: start and end in words, and the match."""

    def hit(m: Column) -> Column:
        start = F.regexp_extract(m, r"\x01([0-9]+)", 1).cast("long")
        words = F.length(m) - F.length(F.replace(m, F.lit(MARK), F.lit("")))
        return F.struct(
            start.alias("start"), (start + words).alias("end"), rule["priority"].alias("priority"), rule["rule"].alias("rule"),
            rule["label"].alias("label"), rule["base"].alias("base"), F.regexp_replace(m, r"\x01[0-9]+", "").alias("match"),
        )

    return F.transform(F.regexp_extract_all(numbered, rule["pattern"], F.lit(0)), hit)


def detections(docs: DataFrame, doc_id: str, text: str, rules: tuple[Rule, ...]) -> DataFrame:
    """rk, doc_id, n_words, hit: one row per detection, and one with a null hit per document without any."""
    keywords = F.from_json(F.lit(json.dumps(sorted({r.keyword for r in rules}))), "array<string>")
    flat = lambda c: F.trim(F.regexp_replace(ascii_lower(c(text)), NOT_WORD, " "))
    rows = keyed(docs, lambda c: c(doc_id).alias("doc_id"), lambda c: flat(c).alias("flat"))
    words = rows.select("rk", "doc_id", F.when(F.col("flat") == "", F.array().cast("array<string>")).otherwise(F.split("flat", " ", -1)).alias("words"))
    gated = words.withColumn("met", F.array_intersect("words", keywords))
    numbered = F.array_join(F.transform("words", lambda w, i: F.concat(w, F.lit(MARK), i.cast("string"))), " ")
    gated = gated.select("rk", "doc_id", F.size("words").cast("long").alias("n_words"), "met", F.when(F.size("met") > 0, F.concat(F.lit(" "), numbered, F.lit(" "))).alias("numbered"))
    tried = F.filter(rule_array(rules), lambda r: F.array_contains(F.col("met"), r["keyword"]))
    hits = F.when(F.size("met") > 0, F.flatten(F.transform(tried, lambda r: _hits(F.col("numbered"), r))))
    return gated.select("rk", "doc_id", "n_words", F.explode_outer(hits).alias("hit"))


def unsuppressed(found: DataFrame) -> DataFrame:
    """``found`` with kept: whether a detection isn't covered by one of the same or a better priority."""
    before = Window.partitionBy("rk").orderBy("hit.start", F.desc("hit.end"), "hit.priority", "hit.rule").rowsBetween(Window.unboundedPreceding, -1)
    # The farthest end so far among detections of each priority or a better one.
    reach = [F.when(F.col("hit.priority") == p, F.max(F.when(F.col("hit.priority") <= p, F.col("hit.end"))).over(before)) for p in sorted(CONFIDENCE)]
    return found.withColumn("kept", F.col("hit").isNotNull() & (F.coalesce(*reach, F.lit(-1)) < F.col("hit.end")))


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: n_words, base_* columns, labels, score and detections (those that stay).

    Documents are counted from the rows of their detections: one exchange, of those alone.
    """
    found = unsuppressed(detections(docs, doc_id, text, rules))
    base, kept, hit = F.col("hit.base"), F.col("kept"), F.col("hit")
    confidence = F.create_map(*[x for p, c in CONFIDENCE.items() for x in (F.lit(p), F.lit(c))])
    joined = lambda cond: F.array_join(F.array_sort(F.collect_set(F.when(cond, hit["label"]))), ",")
    span = F.struct(hit["start"].alias("start"), hit["end"].alias("end"), hit["label"].alias("label"), hit["match"].alias("match"))
    return (
        found.groupBy("rk")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_words").alias("n_words"),
            F.count_if(base).alias("n_base"),
            F.min(F.when(base, hit["start"])).alias("first_word"),
            F.max(F.when(base, hit["start"])).alias("last_word"),
            joined(base).alias("base_labels"),
            joined(base | kept).alias("labels"),
            F.coalesce(F.max(F.when(kept, F.element_at(confidence, hit["priority"]))), F.lit(0.0)).alias("score"),
            F.array_sort(F.collect_list(F.when(kept, span))).alias("detections"),
        )
        .drop("rk")
    )


def op2_license_scan(spark, sf_dir):
    from reqflow.llm.common import read_table

    return scan_licenses(read_table(spark, sf_dir, "documents")).drop("detections")
