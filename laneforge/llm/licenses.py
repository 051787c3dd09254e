"""License scans by ordered signature rules.

Texts become words in lower case, joined by single spaces. A keyword automaton tells which rules
can match at all; only those rules' expressions run. Of the detections, one that lies inside
another goes unless its rule has the better priority; of two equal intervals the rule that comes
first stays. Detections by the base phrases always stay.

Defined cases: a null text counts as empty: no words, no detections, score 0. Word positions
count from 0. Repeated rows and null ids are kept; each row is judged by itself. Texts are
scanned whole. Other columns pass through ``scan``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Delimiters become spaces, and A-Z become a-z, byte by byte. Bytes of other characters stay.
FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else 0x20 if b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in range(256)
)


class Rule(NamedTuple):
    label: str
    pattern: str
    keyword: str
    priority: int
    weight: float
    base: bool = False


# Phrases of the base, with their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Identifiers of licenses, and how texts write their names, in words.
FAMILIES = (
    ("apache-2.0", r"apache (?:software )?license(?: version)? 2(?: 0)?", "apache"),
    ("apache-1.1", r"apache (?:software )?license(?: version)? 1 1", "apache"),
    ("mit", r"mit license", "mit license"),
    ("mit-0", r"mit no attribution(?: license)?", "mit no attribution"),
    ("bsd-2-clause", r"(?:bsd 2 clause|simplified bsd|freebsd)(?: license)?", "bsd"),
    ("bsd-3-clause", r"(?:bsd 3 clause|new bsd|modified bsd)(?: license)?", "bsd"),
    ("bsd-4-clause", r"(?:bsd 4 clause|original bsd)(?: license)?", "bsd"),
    ("0bsd", r"(?:0bsd|bsd zero clause)(?: license)?", "bsd"),
    ("isc", r"isc license", "isc license"),
    ("gpl-1.0", r"gnu general public license(?: as published by the free software foundation)?(?: either)? version 1", "general public"),
    ("gpl-2.0", r"gnu general public license(?: as published by the free software foundation)?(?: either)? version 2", "general public"),
    ("gpl-3.0", r"gnu general public license(?: as published by the free software foundation)?(?: either)? version 3", "general public"),
    ("lgpl-2.0", r"gnu library general public license(?: version 2)?", "library"),
    ("lgpl-2.1", r"gnu lesser general public license(?: as published by the free software foundation)?(?: either)? version 2 1", "lesser"),
    ("lgpl-3.0", r"gnu lesser general public license(?: as published by the free software foundation)?(?: either)? version 3", "lesser"),
    ("agpl-3.0", r"gnu affero general public license(?: version 3)?", "affero"),
    ("gfdl-1.3", r"gnu free documentation license(?: version 1 [0-9])?", "free documentation"),
    ("mpl-1.1", r"mozilla public license(?: version)? 1 1", "mozilla"),
    ("mpl-2.0", r"mozilla public license(?: version)? 2(?: 0)?", "mozilla"),
    ("epl-1.0", r"eclipse public license(?: version)? 1(?: 0)?", "eclipse"),
    ("epl-2.0", r"eclipse public license(?: version)? 2(?: 0)?", "eclipse"),
    ("cddl-1.0", r"common development and distribution license", "distribution license"),
    ("cpl-1.0", r"common public license", "common public"),
    ("eupl-1.2", r"european union public licen[cs]e", "european"),
    ("cc-by-4.0", r"creative commons attribution(?: 4 0)?(?: international)?(?: public)? licen[cs]e", "commons"),
    ("cc-by-sa", r"creative commons attribution share ?alike", "commons"),
    ("cc-by-nc", r"creative commons attribution non ?commercial", "commons"),
    ("cc-by-nd", r"creative commons attribution no ?deriv(?:ative)?s?", "commons"),
    ("cc-by-nc-sa", r"creative commons attribution non ?commercial share ?alike", "commons"),
    ("cc-by-nc-nd", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s?", "commons"),
    ("cc0-1.0", r"(?:cc0(?: 1 0)?(?: universal)?|creative commons zero)", "cc0|commons zero"),
    ("odbl-1.0", r"open (?:data commons open )?database license", "database license"),
    ("odc-by", r"open data commons attribution license", "commons"),
    ("unlicense", r"(?:the unlicense|unlicense org)", "unlicense"),
    ("wtfpl", r"do what the f[a-z]* you want to public license", "want to public"),
    ("zlib", r"zlib(?: libpng)? license", "zlib"),
    ("bsl-1.0", r"boost software license", "boost"),
    ("artistic-1.0", r"artistic license(?: 1 0)?", "artistic"),
    ("artistic-2.0", r"artistic license(?: version)? 2(?: 0)?", "artistic"),
    ("python-2.0", r"python (?:software foundation )?license", "python"),
    ("php-3.01", r"php license", "php license"),
    ("postgresql", r"postgresql licen[cs]e", "postgresql"),
    ("openssl", r"openssl license", "openssl"),
    ("ruby", r"ruby license", "ruby"),
    ("ofl-1.1", r"(?:sil )?open font license", "open font"),
    ("ms-pl", r"microsoft public license", "microsoft"),
    ("ms-rl", r"microsoft reciprocal license", "microsoft"),
    ("afl-3.0", r"academic free license", "academic"),
    ("osl-3.0", r"open software license", "open software"),
    ("upl-1.0", r"universal permissive license", "permissive"),
    ("ncsa", r"(?:university of illinois ncsa|ncsa) open source license", "ncsa open"),
    ("vim", r"vim license", "vim license"),
    ("x11", r"x11 license", "x11"),
    ("busl-1.1", r"business source license", "business source"),
    ("sspl-1.0", r"server side public license", "server side"),
    ("elastic-2.0", r"elastic license(?: 2 0)?", "elastic"),
    ("openrail", r"(?:bigscience )?open ?rail(?: m)?(?: license)?", "rail"),
    ("public-domain", r"public domain", "public domain"),
    ("proprietary", r"proprietary and confidential", "proprietary"),
    ("copyright", r"copyright (?:c )?(?:19|20)[0-9]{2}", "copyright"),
)

# Families whose names are not licenses one can be licensed under; their identifiers are no SPDX ones.
NO_LICENSE = {"public-domain", "proprietary", "copyright"}

# Licenses whose identifier is a word of its own, so that it may start the sentence after "license".
PLAIN_WORDS = {"ruby", "vim"}

# How a text takes up a license, where ID is its identifier in words and NAME its name.
FORMS = (
    ("SPDX license identifier ID", r"spdx license identifier ID(?: only| or later| plus)?", 1, 1.0),
    ("licensed under NAME", r"(?:dual )?(?:re)?licen[cs]ed (?:to you )?under (?:the )?(?:terms of (?:the )?)?NAME", 2, 0.95),
    ("distributed under NAME", r"(?:distributed|released|published|available|provided|made available) under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?NAME", 2, 0.9),
    ("subject to NAME", r"(?:subject to|governed by|in accordance with|pursuant to) (?:the )?(?:terms of (?:the )?)?NAME", 3, 0.85),
    ("license: ID", r"licen[cs]e ID", 4, 0.8),
    ("NAME", r"NAME", 5, 0.6),
)

# Sentences that stand in the text or the notice of a license, with a keyword that each holds.
SENTENCES = (
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "hereby granted free of charge", 0.95),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "substantial portions", 0.9),
    ("x11", r"except as contained in this notice the name of the x consortium shall not be used", "x consortium", 0.95),
    ("bsl-1.0", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software", "person or organization", 0.95),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms", 0.9),
    ("bsd", r"redistributions of source code must retain the above copyright notice", "redistributions of source", 0.85),
    ("bsd", r"redistributions in binary form must reproduce the above copyright notice", "redistributions in binary", 0.85),
    ("bsd-3-clause", r"neither the names? of (?:[^ ]+ ){1,12}?nor the names of (?:its|their|other|any) contributors may be used to endorse", "may be used to endorse", 0.9),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment", "advertising materials", 0.95),
    ("isc", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice", "permission to use copy modify", 0.95),
    ("0bsd", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted(?! provided)", "permission to use copy modify", 0.9),
    ("postgresql", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted", "without a written agreement", 0.95),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", "without any express or implied", 0.9),
    ("zlib", r"altered source versions must be plainly marked as such", "plainly marked", 0.95),
    ("apache-2.0", r"you may not use this file except in compliance with the license you may obtain a copy of the license at https? www apache org licenses license 2 0", "except in compliance", 1.0),
    ("apache-2.0", r"www apache org licenses license 2 0", "apache org licenses", 0.95),
    ("apache-2.0", r"terms and conditions for use reproduction and distribution", "use reproduction and distribution", 0.8),
    ("gpl", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "is free software you can", 0.9),
    ("gpl", r"you should have received a copy of the gnu general public license", "received a copy of the gnu", 0.8),
    ("gpl-2.0", r"gnu general public license as published by the free software foundation either version 2 of the license", "either version 2", 0.85),
    ("gpl-3.0", r"gnu general public license as published by the free software foundation either version 3 of the license", "either version 3", 0.95),
    ("lgpl", r"you should have received a copy of the gnu (?:lesser|library) general public license", "received a copy of the gnu", 0.85),
    ("lgpl", r"this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license", "is free software you can", 0.9),
    ("agpl-3.0", r"you should have received a copy of the gnu affero general public license", "received a copy of the gnu", 0.9),
    ("gfdl", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", "modify this document", 0.95),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public license v(?:ersion)? ?2 0", "source code form is subject", 1.0),
    ("mpl-1.1", r"the contents of this file are subject to the mozilla public license version 1 1", "subject to the mozilla", 1.0),
    ("epl", r"this program and the accompanying materials are made available under the terms of the eclipse public license", "accompanying materials", 0.9),
    ("cddl", r"the contents of this file are subject to the terms of the common development and distribution license", "common development", 0.95),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "unencumbered software", 1.0),
    ("cc0-1.0", r"to the extent possible under law (?:[^ ]+ ){1,12}?(?:has|have) waived all copyright and related or neighboring rights", "neighboring rights", 0.95),
    ("ofl-1.1", r"this font software is licensed under the sil open font license", "font software", 0.95),
    ("artistic-1.0", r"the intent of this document is to state the conditions under which a package may be copied", "a package may be copied", 0.95),
    ("upl-1.0", r"subject to the condition set forth below permission is hereby granted to any person obtaining a copy of this software associated documentation and or data", "condition set forth below", 0.95),
    ("wtfpl", r"you just do what the f[a-z]* you want to", "you want to", 0.9),
    ("ncsa", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software", "to deal with the software", 0.95),
    ("mit", r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement", "purpose and noninfringement", 0.75),
    ("mit", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise", "authors or copyright holders be liable", 0.75),
    ("bsd", r"this software is provided by the (?:[^ ]+ ){1,8}?and contributors as is and any express or implied warranties", "and contributors as is and any", 0.8),
    ("bsd-2-clause", r"this software is provided by the author as is and any express or implied warranties", "by the author as is and any", 0.75),
    ("bsd-4-clause", r"this product includes software developed by the university of california berkeley and its contributors", "developed by the university of california", 0.95),
    ("hpnd", r"permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted", "any purpose and without fee", 0.9),
    ("isc", r"the software is provided as is and the authors? disclaims? all warranties with regard to this software", "all warranties with regard to this", 0.8),
    ("apache-2.0", r"licensed to the apache software foundation asf under one or more contributor license agreements", "contributor license agreements", 0.95),
    ("apache-2.0", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "agreed to in writing", 0.85),
    ("apache-2.0", r"grant of copyright license subject to the terms and conditions of this license each contributor hereby grants to you", "grant of copyright license", 0.95),
    ("apache-2.0", r"grant of patent license subject to the terms and conditions of this license each contributor hereby grants to you", "grant of patent license", 0.95),
    ("apache-1.1", r"this product includes software developed by the apache software foundation", "software developed by the apache", 0.85),
    ("gpl", r"this program is distributed in the hope that it will be useful but without any warranty", "hope that it will be useful", 0.85),
    ("gpl", r"this is free software and you are welcome to redistribute it under certain conditions", "welcome to redistribute", 0.7),
    ("gpl-1.0", r"the license agreements of most software companies try to keep users at the mercy of those companies", "mercy of those companies", 0.95),
    ("gpl-1.0", r"general public license version 1 february 1989", "february 1989", 0.95),
    ("gpl-2.0", r"general public license version 2 june 1991", "june 1991", 0.95),
    ("gpl-2.0", r"the licenses for most software are designed to take away your freedom to share and change it", "take away your freedom", 0.9),
    ("gpl-2.0", r"you may not copy modify sublicense or distribute the program except as expressly provided under this license", "sublicense or distribute the program", 0.95),
    ("gpl-3.0", r"gnu general public license version 3 29 june 2007", "29 june 2007", 0.95),
    ("gpl-3.0", r"the licenses for most software and other practical works are designed to take away your freedom", "other practical works", 0.9),
    ("gpl-3.0", r"this license explicitly affirms your unlimited permission to run the unmodified program", "unlimited permission to run", 0.95),
    ("gpl-3.0", r"additional permissions are terms that supplement the terms of this license by making exceptions", "terms that supplement", 0.9),
    ("gpl-classpath", r"linking this library statically or dynamically with other modules is making a combined work based on this library", "statically or dynamically", 0.9),
    ("gpl-classpath", r"the copyright holders of this library give you permission to link this library with independent modules", "with independent modules", 0.95),
    ("gpl-gcc-exception", r"you have permission to propagate a work of target code formed by combining the runtime library with independent modules", "propagate a work of target code", 0.95),
    ("gpl-gcc-exception", r"gcc runtime library exception", "gcc runtime", 0.9),
    ("lgpl-2.0", r"gnu library general public license version 2 june 1991", "library general public license version 2", 0.95),
    ("lgpl-2.1", r"gnu lesser general public license version 2 1 february 1999", "february 1999", 0.95),
    ("lgpl-2.1", r"a program that contains no derivative of any portion of the library but is designed to work with the library", "derivative of any portion of the library", 0.9),
    ("lgpl-3.0", r"gnu lesser general public license version 3 29 june 2007", "lesser general public license version 3", 0.95),
    ("lgpl-3.0", r"this version of the gnu lesser general public license incorporates the terms and conditions of version 3", "incorporates the terms", 0.95),
    ("agpl-3.0", r"gnu affero general public license version 3 19 november 2007", "19 november 2007", 0.95),
    ("agpl-3.0", r"remote network interaction use with the gnu general public license", "remote network interaction", 0.95),
    ("agpl-3.0", r"your modified version must prominently offer all users interacting with it remotely through a computer network", "users interacting with it remotely", 0.95),
    ("gfdl", r"with no invariant sections no front cover texts and no back cover texts", "invariant sections", 0.9),
    ("gfdl", r"the purpose of this license is to make a manual textbook or other functional and useful document free", "functional and useful document", 0.95),
    ("mpl-2.0", r"if a copy of the mpl was not distributed with this file you can obtain one at", "copy of the mpl", 0.95),
    ("mpl-2.0", r"covered software is provided under this license on an as is basis", "covered software is provided", 0.9),
    ("mpl-1.1", r"the contents of this file may be used under the terms of either the gnu general public license", "used under the terms of either", 0.7),
    ("npl-1.1", r"subject to the netscape public license", "netscape public", 0.95),
    ("epl-1.0", r"the accompanying program is provided under the terms of this eclipse public license agreement", "eclipse public license agreement", 0.95),
    ("epl-1.0", r"eclipse public license v1 0", "eclipse public license v1", 0.85),
    ("epl-2.0", r"the accompanying materials are made available under the terms of the eclipse public license (?:v |version )?2 0", "accompanying materials", 0.95),
    ("epl-2.0", r"eclipse public license v2 0", "eclipse public license v2", 0.85),
    ("cpl-1.0", r"the accompanying program is provided under the terms of this common public license agreement", "common public license agreement", 0.95),
    ("ipl-1.0", r"ibm public license", "ibm public", 0.8),
    ("cddl-1.0", r"you can obtain a copy of the license at usr src opensolaris license", "opensolaris license", 0.95),
    ("bsl-1.0", r"the copyright notices in the software and this entire statement including the above license grant", "this entire statement", 0.95),
    ("zlib", r"permission is granted to anyone to use this software for any purpose including commercial applications", "including commercial applications", 0.95),
    ("zlib", r"the origin of this software must not be misrepresented", "must not be misrepresented", 0.9),
    ("zlib", r"this notice may not be removed or altered from any source distribution", "altered from any source distribution", 0.9),
    ("libpng", r"the png reference library is supplied as is", "png reference library", 0.95),
    ("unlicense", r"anyone is free to copy modify publish use compile sell or distribute this software", "publish use compile", 0.95),
    ("unlicense", r"dedicate any and all copyright interest in the software to the public domain", "all copyright interest", 0.95),
    ("cc0-1.0", r"the person who associated a work with this deed has dedicated the work to the public domain", "work with this deed", 0.95),
    ("cc0-1.0", r"unconditionally waives abandons and surrenders all of affirmer s copyright and related rights", "waives abandons and surrenders", 0.95),
    ("cc0-1.0", r"creativecommons org publicdomain zero 1 0", "publicdomain zero", 1.0),
    ("public-domain", r"creativecommons org publicdomain mark 1 0", "publicdomain mark", 0.9),
    ("public-domain", r"(?:placed|released|dedicated|put) (?:in|into|to) the public domain", "the public domain", 0.8),
    ("cc", r"this work is licensed under (?:a|the) creative commons", "creative commons", 0.7),
    ("cc", r"by exercising the licensed rights defined below you accept and agree to be bound by the terms and conditions of this creative commons", "exercising the licensed rights", 0.9),
    ("cc-by", r"you must give appropriate credit provide a link to the license and indicate if changes were made", "give appropriate credit", 0.8),
    ("cc-by-sa", r"you must distribute your contributions under the same license as the original", "same license as the original", 0.85),
    ("cc-by-nc", r"you may not use the material for commercial purposes", "the material for commercial", 0.8),
    ("cc-by-nd", r"you may not distribute the modified material", "the modified material", 0.8),
    ("cc-by-2.0", r"creativecommons org licenses by 2 [05]", "creativecommons org licenses by 2", 1.0),
    ("cc-by-3.0", r"creativecommons org licenses by 3 0", "creativecommons org licenses by 3", 1.0),
    ("cc-by-4.0", r"creativecommons org licenses by 4 0", "creativecommons org licenses by 4", 1.0),
    ("cc-by-sa", r"creativecommons org licenses by sa [1-4] [05]", "licenses by sa", 1.0),
    ("cc-by-nc", r"creativecommons org licenses by nc [1-4] [05]", "licenses by nc", 1.0),
    ("cc-by-nd", r"creativecommons org licenses by nd [1-4] [05]", "licenses by nd", 1.0),
    ("cc-by-nc-sa", r"creativecommons org licenses by nc sa [1-4] [05]", "licenses by nc sa", 1.0),
    ("cc-by-nc-nd", r"creativecommons org licenses by nc nd [1-4] [05]", "licenses by nc nd", 1.0),
    ("odbl-1.0", r"opendatacommons org licenses odbl", "licenses odbl", 1.0),
    ("odc-by", r"opendatacommons org licenses by", "opendatacommons org licenses by", 1.0),
    ("pddl-1.0", r"public domain dedication and license", "dedication and license", 0.9),
    ("dbcl-1.0", r"database contents license", "database contents", 0.85),
    ("ofl-1.1", r"the goals of the open font license ofl are to stimulate worldwide development", "stimulate worldwide", 0.95),
    ("ofl-1.1", r"permission is hereby granted free of charge to any person obtaining a copy of the font software", "copy of the font software", 0.95),
    ("bitstream-vera", r"permission is hereby granted free of charge to any person obtaining a copy of the fonts accompanying this license", "fonts accompanying this", 0.95),
    ("python-2.0", r"psf is making python available to licensee on an as is basis", "psf is making", 0.95),
    ("python-2.0", r"this license agreement is between the python software foundation", "agreement is between the python", 0.95),
    ("php-3.01", r"this product includes php software freely available from", "includes php software", 0.95),
    ("php-3.01", r"the name php must not be used to endorse or promote products derived from this software", "the name php must", 0.95),
    ("openssl", r"this product includes software developed by the openssl project for use in the openssl toolkit", "openssl toolkit", 0.95),
    ("ssleay", r"this product includes cryptographic software written by eric young", "cryptographic software written", 0.95),
    ("artistic-2.0", r"this license establishes the terms under which a given free software package may be copied modified distributed", "a given free software package", 0.95),
    ("ms-pl", r"this license governs use of the accompanying software if you use the software you accept this license", "governs use of the accompanying", 0.85),
    ("ms-rl", r"reciprocal grants for any file you distribute that contains code from the software", "reciprocal grants", 0.95),
    ("sspl-1.0", r"make the functionality of the program or a modified version available to third parties as a service", "to third parties as a service", 0.95),
    ("elastic-2.0", r"you may not provide the software to third parties as a hosted or managed service", "hosted or managed service", 0.95),
    ("busl-1.1", r"the right to copy modify create derivative works redistribute and make non production use of the licensed work", "non production use", 0.95),
    ("commons-clause", r"commons clause license condition", "commons clause", 0.95),
    ("commons-clause", r"the license does not grant to you the right to sell the software", "right to sell the software", 0.9),
    ("openrail", r"use based restrictions as referenced in paragraph 5", "use based restrictions", 0.95),
    ("openrail", r"you agree not to use the model or derivatives of the model", "derivatives of the model", 0.9),
    ("llama", r"llama [1-4](?: [0-9])? community license(?: agreement)?", "community license", 0.95),
    ("gemma", r"gemma terms of use", "gemma terms", 0.9),
    ("json", r"the software shall be used for good not evil", "good not evil", 1.0),
    ("beerware", r"you think this stuff is worth it you can buy me a beer", "buy me a beer", 1.0),
    ("unicode", r"unicode inc license agreement data files and software", "unicode inc license", 0.95),
    ("w3c", r"w3c software (?:and document )?notice and license", "notice and license", 0.9),
    ("sleepycat", r"redistributions in any form must be accompanied by information on how to obtain complete source code", "obtain complete source code", 0.95),
    ("ruby", r"ruby is copyrighted free software by yukihiro matsumoto", "yukihiro matsumoto", 0.95),
    ("vim", r"there are no restrictions on distributing unmodified copies of vim", "copies of vim", 0.95),
    ("tcl", r"the authors hereby grant permission to use copy modify distribute and license this software and its documentation for any purpose", "authors hereby grant permission", 0.95),
    ("lppl-1.3c", r"this work may be distributed and or modified under the conditions of the latex project public license", "latex project", 0.95),
    ("qpl-1.0", r"the q public license", "q public license", 0.85),
    ("apsl-2.0", r"apple public source license", "apple public source", 0.9),
    ("zpl-2.1", r"zope public license", "zope public", 0.9),
    ("rpl-1.5", r"reciprocal public license", "reciprocal public", 0.9),
    ("cecill-2.1", r"licen[cs]e cecill(?: v?2 1)?", "cecill", 0.85),
    ("mulanpsl-2.0", r"mulan psl v2", "mulan psl", 0.95),
    ("eupl-1.2", r"licensed under the eupl(?: version| v)?(?: 1 2)?", "under the eupl", 0.9),
    ("ogl-3.0", r"contains public sector information licensed under the open government licence v3 0", "public sector information", 0.95),
    ("ogl", r"open government licence", "open government", 0.85),
    ("afl-3.0", r"licensed under the academic free license version 3 0", "academic free license version", 0.95),
    ("osl-3.0", r"licensed under the open software license version 3 0", "open software license version", 0.95),
    ("intel", r"intel open source license", "intel open source", 0.9),
    ("proprietary", r"unauthorized copying of this file via any medium is strictly prohibited", "unauthorized copying of this file", 0.95),
    ("proprietary", r"this software is the confidential and proprietary information of", "confidential and proprietary information", 0.9),
    ("proprietary", r"licensed materials property of", "licensed materials property", 0.8),
)

# Words that may stand after a short name and its bare number.
AFTER = "only|or|and|licen[cs]e|licen[cs]ed|as|with|in|compatible|compliant|terms|copyright|see|code|software|library|project|by|is|which|that|this|the"


def numbered(name: str, number: str) -> str:
    """A short name with a version: marked as one, in full, joined to the name, or bare where no other noun follows that the number may count."""
    later = "(?: only| or later)?"
    return f"(?:{name}(?: ?v| ?v | ?version ){number}(?: 0)?{later}|{name} ?{number} 0{later}|{name}{number}{later}|{name} {number}(?: only| or later)|{name} {number}(?= (?:$|{AFTER})))"


# Short names as texts write them, in words.
SHORT = (
    ("gpl-1.0", numbered("gpl", "1"), "gpl"),
    ("gpl-2.0", numbered("gpl", "2"), "gpl"),
    ("gpl-3.0", numbered("gpl", "3"), "gpl"),
    ("lgpl-2.0", numbered("lgpl", "2"), "lgpl"),
    ("lgpl-2.1", r"lgpl ?v?(?: ?version )?2 1(?: only| or later)?", "lgpl"),
    ("lgpl-3.0", numbered("lgpl", "3"), "lgpl"),
    ("agpl-3.0", numbered("agpl", "3"), "agpl"),
    ("gfdl-1.3", r"gfdl ?v?(?: ?version )?1 3", "gfdl"),
    ("apache-2.0", r"(?:apache|asl) ?v?2 0", "apache|asl"),
    ("apache-1.1", r"(?:apache|asl) ?v?1 1", "apache|asl"),
    ("mpl-1.1", r"mpl ?v?1 1", "mpl"),
    ("mpl-2.0", r"mpl ?v?2(?: 0)?", "mpl"),
    ("epl-1.0", r"epl ?v?1 0", "epl"),
    ("epl-2.0", r"epl ?v?2 0", "epl"),
    ("cddl-1.0", r"cddl ?v?1(?: 0)?", "cddl"),
    ("eupl-1.2", r"eupl ?v?1 2", "eupl"),
    ("cc-by-4.0", r"cc by 4 0", "cc by"),
    ("cc-by-sa", r"cc by sa(?: [1-4] [05])?", "cc by sa"),
    ("cc-by-nc", r"cc by nc(?: [1-4] [05])?", "cc by nc"),
    ("cc-by-nd", r"cc by nd(?: [1-4] [05])?", "cc by nd"),
    ("cc-by-nc-sa", r"cc by nc sa(?: [1-4] [05])?", "cc by nc sa"),
    ("cc-by-nc-nd", r"cc by nc nd(?: [1-4] [05])?", "cc by nc nd"),
    ("bsd-2-clause", r"(?:2|two) clause bsd(?: license)?", "clause bsd"),
    ("bsd-3-clause", r"(?:3|three) clause bsd(?: license)?", "clause bsd"),
    ("bsd-4-clause", r"(?:4|four) clause bsd(?: license)?", "clause bsd"),
    ("mit", r"(?:mit x11|x11 mit|expat)(?: license)?", "mit x11|x11 mit|expat"),
    ("bsl-1.0", r"bsl 1 0", "bsl"),
    ("busl-1.1", r"(?:busl|bsl) 1 1", "busl|bsl"),
)


def either_spelling(name: str, keyword: str) -> tuple[str, str]:
    """A license's name in both spellings of the word, and its keywords in each of them."""
    keywords = [k.replace("license", spelling) for k in keyword.split("|") for spelling in (("license", "licence") if "license" in k else ("license",))]
    return name.replace("licen[cs]e", "license").replace("license", "licen[cs]e"), "|".join(keywords)


def rules() -> list[Rule]:
    """The ordered rules: the base's, then each form for each license it can occur with, sentences of licenses, and short names."""
    found = [Rule(label, phrase, phrase, 0, 0.5, True) for phrase, label in BASE]
    for label, name, keyword in FAMILIES:
        name, keyword = either_spelling(name, keyword)
        identifier = " ".join(re.findall("[a-z0-9]+", label))
        for _, form, priority, weight in FORMS:
            if label in NO_LICENSE and form != "NAME" or label in PLAIN_WORDS and form == "licen[cs]e ID":
                continue
            pattern = form.replace("NAME", f"(?:{name})").replace("ID", identifier)
            found.append(Rule(label, pattern, "licen" if "ID" in form else keyword, priority, weight))
    found += [Rule(label, pattern, keyword, 2, weight) for label, pattern, keyword, weight in SENTENCES]
    return found + [Rule(label, pattern, keyword, 4, 0.75) for label, pattern, keyword in SHORT]


@lru_cache(maxsize=1)
def machine() -> tuple[list[Rule], list[re.Pattern], ahocorasick.Automaton]:
    """Rules, their expressions, and an automaton from keywords to the rules that need them."""
    listed = rules()
    keys: dict[str, list[int]] = {}
    for n, rule in enumerate(listed):
        for k in rule.keyword.split("|"):
            keys.setdefault(k, []).append(n)
    automaton = ahocorasick.Automaton()
    for k, ns in keys.items():
        automaton.add_word(k, tuple(ns))
    automaton.make_automaton()
    return listed, [re.compile(rf"(?=( {r.pattern}) )" if r.base else rf" {r.pattern}(?= )") for r in listed], automaton


def normal(text: bytes) -> bytes:
    """Words in lower case with one space before and after each."""
    words = text.translate(FOLD).split()
    return b" " + b" ".join(words) + b" " if words else b""


def detections(norm: str) -> list[tuple[int, int, int]]:
    """Start and end in characters, and rule, of what stays after suppression, in order of start."""
    listed, patterns, automaton = machine()
    possible = sorted({n for _, ns in automaton.iter(norm) for n in ns})
    if not possible:
        return []
    base, found = [], []
    for n in possible:
        for m in patterns[n].finditer(norm):
            if listed[n].base:
                base.append((m.start(), m.end(1), n))
            else:
                found.append((m.start(), m.end(), n))
    return sorted(base + suppressed(found))


def suppressed(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Drops detections contained in one whose rule has as good a priority or a better one.

    Swept by start, with the furthest end reached so far for each priority.
    """
    listed = machine()[0]
    kept, reach = [], {}
    for start, end, n in sorted(found, key=lambda f: (f[0], -f[1], listed[f[2]].priority, f[2])):
        if not any(end <= far for priority, far in reach.items() if priority <= listed[n].priority):
            kept.append((start, end, n))
        reach[listed[n].priority] = max(end, reach.get(listed[n].priority, -1))
    return kept


def summary(text: bytes) -> tuple:
    """The row of results for a text's UTF-8 bytes."""
    listed = machine()[0]
    norm = normal(text)
    n_words = norm.count(b" ") - 1 if norm else 0
    line = norm.decode()
    found = detections(line)
    at, words, last = [], 0, 0
    for start, _, n in found:
        words += line.count(" ", last, start)
        last = start
        at.append((words, n))
    base = [w for w, n in at if listed[n].base]
    labels = sorted({listed[n].label for _, n in at})
    miss = 1.0
    for label in labels:
        miss *= 1 - max(listed[n].weight for _, n in at if listed[n].label == label)
    spans = [f"{listed[n].label}:{start}:{end}" for start, end, n in found]
    return (
        n_words, len(base), min(base, default=None), max(base, default=None),
        ",".join(sorted({listed[n].label for _, n in at if listed[n].base})), ",".join(labels), 1 - miss if labels else 0.0, spans,
    )


RESULT = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, detections array<string>"
KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(pa.string()))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with a struct ``license`` of counts, labels, score and detections, in place of a column of that name."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [summary(x or b"") for x in batch.column("_text").to_pylist()]
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(KINDS)]
            struct = pa.StructArray.from_arrays(columns, names=[f.split()[0] for f in RESULT.split(", ")])
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(names))), struct], names=[*(f"c{i}" for i in range(len(names))), "license"])

    source = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(names)), F.col(text).cast("binary").alias("_text"))
    kept = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema))
    fields = ", ".join(f.replace(" ", ": ", 1) for f in RESULT.split(", "))
    out = source.mapInArrow(run, f"{kept}, license struct<{fields}>")
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names) if c != "license"), "license")


def found_licenses(docs: DataFrame) -> DataFrame:
    """Results by document."""
    small = docs.select("doc_id", "text")
    names = [f.split()[0] for f in RESULT.split(", ")]
    return scan(small).select("doc_id", *(F.col("license")[n].alias(n) for n in names))
