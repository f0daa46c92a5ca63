"""Signature rules of the license scan, one per line, in order.

``label | keyword | strength | pattern``. Patterns run over lower-case words joined by single spaces
(so "Apache-2.0" reads "apache 2 0") and must start and end at a word. Every match contains the keyword,
which starts at a word; its first word (``licen``: any form of licence) is looked up among the text's
words before anything else. Rules whose keyword a text lacks are not tried. An earlier
rule has priority over a later one. Strength is the confidence of one detection.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    number: int
    label: str
    keyword: str
    strength: float
    pattern: str

    @property
    def anchors(self) -> list[str]:
        """Words of which a text with this keyword has at least one."""
        *before, last = self.keyword.split(" ")
        return [before[0]] if before else LICENCE if last == "licen" else [last]


LICENCE = ["license", "licence", "licensed", "licenced", "licenses", "licences"]
BASE = """
cc-by | cc by | 0.5 | cc by
gpl | general public license | 0.5 | general public license
reserved | all rights reserved | 0.3 | all rights reserved
"""

RULES = r"""
agpl-3.0-or-later | spdx | 1.0 | spdx license identifier agpl 3 0 or later
agpl-3.0-only | spdx | 1.0 | spdx license identifier agpl 3 0(?: only)?
lgpl-3.0-or-later | spdx | 1.0 | spdx license identifier lgpl 3 0 or later
lgpl-3.0-only | spdx | 1.0 | spdx license identifier lgpl 3 0(?: only)?
lgpl-2.1-or-later | spdx | 1.0 | spdx license identifier lgpl 2 1 or later
lgpl-2.1-only | spdx | 1.0 | spdx license identifier lgpl 2 1(?: only)?
lgpl-2.0-only | spdx | 1.0 | spdx license identifier lgpl 2 0(?: only| or later)?
gpl-3.0-or-later | spdx | 1.0 | spdx license identifier gpl 3 0 or later
gpl-3.0-only | spdx | 1.0 | spdx license identifier gpl 3 0(?: only)?
gpl-2.0-or-later | spdx | 1.0 | spdx license identifier gpl 2 0 or later
gpl-2.0-only | spdx | 1.0 | spdx license identifier gpl 2 0(?: only)?
gpl-1.0-only | spdx | 1.0 | spdx license identifier gpl 1 0(?: only| or later)?
apache-2.0 | spdx | 1.0 | spdx license identifier apache 2 0
apache-1.1 | spdx | 1.0 | spdx license identifier apache 1 1
mit-0 | spdx | 1.0 | spdx license identifier mit 0
mit | spdx | 1.0 | spdx license identifier mit
bsd-3-clause | spdx | 1.0 | spdx license identifier bsd 3 clause
bsd-2-clause | spdx | 1.0 | spdx license identifier bsd 2 clause
bsd-4-clause | spdx | 1.0 | spdx license identifier bsd 4 clause
0bsd | spdx | 1.0 | spdx license identifier 0bsd
isc | spdx | 1.0 | spdx license identifier isc
mpl-2.0 | spdx | 1.0 | spdx license identifier mpl 2 0
mpl-1.1 | spdx | 1.0 | spdx license identifier mpl 1 1
epl-2.0 | spdx | 1.0 | spdx license identifier epl 2 0
epl-1.0 | spdx | 1.0 | spdx license identifier epl 1 0
eupl-1.2 | spdx | 1.0 | spdx license identifier eupl 1 2
cddl-1.0 | spdx | 1.0 | spdx license identifier cddl 1 0
cc0-1.0 | spdx | 1.0 | spdx license identifier cc0 1 0
cc-by-4.0 | spdx | 1.0 | spdx license identifier cc by 4 0
cc-by-sa-4.0 | spdx | 1.0 | spdx license identifier cc by sa 4 0
cc-by-nc-4.0 | spdx | 1.0 | spdx license identifier cc by nc 4 0
unlicense | spdx | 1.0 | spdx license identifier unlicense
wtfpl | spdx | 1.0 | spdx license identifier wtfpl
zlib | spdx | 1.0 | spdx license identifier zlib
bsl-1.0 | spdx | 1.0 | spdx license identifier bsl 1 0
artistic-2.0 | spdx | 1.0 | spdx license identifier artistic 2 0
apache-2.0 | apache | 1.0 | licensed under the apache license version 2 0(?: the license)?
apache-2.0 | apache | 1.0 | (?:http|https) www apache org licenses license 2 0(?: txt| html)?
apache-2.0 | apache | 0.95 | apache (?:software )?license (?:version |v ?)?2(?: 0)?
apache-2.0 | apache | 0.9 | apache (?:license )?v?2 0
apache-2.0 | apache | 0.9 | asl 2 0 apache
apache-1.1 | apache | 0.95 | apache (?:software )?license (?:version |v ?)?1 1
apache-1.0 | apache | 0.95 | apache (?:software )?license (?:version |v ?)?1 0
apache | apache | 0.7 | apache (?:software |public )?licen[sc]e
agpl-3.0-or-later | affero | 1.0 | gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version
agpl-3.0 | affero | 0.95 | (?:gnu )?affero general public license (?:version |v ?)?3(?: 0)?
agpl-3.0 | agpl | 0.9 | (?:gnu )?agpl ?v?3(?: 0)?
agpl | affero | 0.7 | (?:gnu )?affero (?:general public )?licen[sc]e
agpl | agpl | 0.6 | (?:gnu )?agpl(?:v3)?
lgpl-3.0-or-later | lesser | 1.0 | gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version
lgpl-2.1-or-later | lesser | 1.0 | gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version
lgpl-3.0 | lesser | 0.95 | (?:gnu )?lesser general public license (?:version |v ?)?3(?: 0)?
lgpl-2.1 | lesser | 0.95 | (?:gnu )?lesser general public license (?:version |v ?)?2 1
lgpl-2.0 | library | 0.95 | (?:gnu )?library general public license (?:version |v ?)?2(?: 0)?
lgpl | lesser | 0.75 | (?:gnu )?lesser general public licen[sc]e
lgpl | library | 0.75 | (?:gnu )?library general public licen[sc]e
lgpl-3.0 | lgpl | 0.9 | (?:gnu )?lgpl (?:version |v ?)?3(?: 0)?(?: or later)?
lgpl-3.0 | lgplv3 | 0.9 | (?:gnu )?lgplv3
lgpl-2.1 | lgpl | 0.9 | (?:gnu )?lgpl (?:version |v ?)?2 1(?: or later)?
lgpl | lgpl | 0.6 | (?:gnu )?lgpl
gpl-3.0-or-later | general public | 1.0 | gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version
gpl-2.0-or-later | general public | 1.0 | gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version
gpl-3.0 | general public | 0.95 | (?:the )?(?:gnu )?general public license (?:version |v ?)?3(?: 0)?
gpl-2.0 | general public | 0.95 | (?:the )?(?:gnu )?general public license (?:version |v ?)?2(?: 0)?
gpl-1.0 | general public | 0.95 | (?:the )?(?:gnu )?general public license (?:version |v ?)?1(?: 0)?
gpl | general public | 0.75 | gnu general public licen[sc]e
gpl-3.0 | www gnu | 0.95 | (?:http|https) www gnu org licenses gpl(?: 3 0)?(?: txt| html| en html)?
lgpl | www gnu | 0.9 | (?:http|https) www gnu org licenses lgpl(?: 3 0| 2 1)?(?: txt| html| en html)?
agpl | www gnu | 0.9 | (?:http|https) www gnu org licenses agpl(?: 3 0)?(?: txt| html| en html)?
gpl | www gnu | 0.8 | (?:http|https) www gnu org (?:licenses|copyleft)(?: html)?
gpl-3.0 | gplv3 | 0.9 | (?:gnu )?gplv3
gpl-2.0 | gplv2 | 0.9 | (?:gnu )?gplv2
gpl-3.0 | gpl | 0.9 | (?:gnu )?gpl (?:version |v ?)?3(?: 0)?(?: or later| only)?
gpl-2.0 | gpl | 0.9 | (?:gnu )?gpl (?:version |v ?)?2(?: 0)?(?: or later| only)?
gpl | gnu gpl | 0.7 | gnu gpl
gpl | gpl | 0.6 | (?:licensed|released|distributed|available) under (?:the )?gpl
gfdl-1.3 | free documentation | 0.95 | (?:gnu )?free documentation license (?:version |v ?)?1 3(?: or any later version)?
gfdl-1.2 | free documentation | 0.95 | (?:gnu )?free documentation license (?:version |v ?)?1 2(?: or any later version)?
gfdl | free documentation | 0.8 | (?:gnu )?free documentation licen[sc]e
mit | free of charge | 1.0 | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | mit | 0.95 | (?:licensed|released|distributed|available) under the (?:terms of the )?mit licen[sc]e
mit | mit | 0.95 | (?:http|https) (?:www )?opensource org licenses mit(?: license)?(?: php| html)?
mit-0 | mit | 0.95 | mit no attribution(?: license)?
x11 | x11 | 0.9 | (?:mit )?x11 licen[sc]e
expat | expat | 0.9 | expat licen[sc]e
mit | mit | 0.85 | (?:the )?mit licen[sc]e
mit | mit | 0.8 | licen[sc]e mit
bsd-3-clause | redistribution | 1.0 | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met .{0,900}? neither the name of
bsd-2-clause | redistribution | 0.9 | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd-4-clause | advertising | 0.9 | all advertising materials mentioning features or use of this software must display the following acknowledg?e?ment
bsd-4-clause | bsd | 0.95 | (?:original|old|4 clause) bsd(?: licen[sc]e)?
bsd-4-clause | bsd | 0.95 | bsd 4 clause(?: licen[sc]e)?
bsd-3-clause | bsd | 0.95 | (?:new|modified|revised|3 clause) bsd(?: licen[sc]e)?
bsd-3-clause | bsd | 0.95 | bsd 3 clause(?: clear)?(?: licen[sc]e)?
bsd-2-clause | bsd | 0.95 | (?:simplified|freebsd|2 clause) bsd(?: licen[sc]e)?
bsd-2-clause | bsd | 0.95 | bsd 2 clause(?: patent)?(?: licen[sc]e)?
0bsd | 0bsd | 0.95 | (?:licen[sc]e )?0bsd(?: licen[sc]e)?
0bsd | zero clause | 0.95 | (?:bsd )?zero clause bsd(?: licen[sc]e)?
bsd | bsd | 0.75 | (?:the )?bsd (?:style )?licen[sc]e
bsd | bsd | 0.7 | (?:licensed|released|distributed) under (?:the )?bsd
isc | permission to use | 1.0 | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc | isc | 0.9 | (?:the )?isc licen[sc]e
ntp | permission to use | 0.95 | permission to use copy modify and distribute this software and its documentation for any purpose (?:and )?with(?:out| or without) fee is hereby granted
mpl-2.0 | mozilla | 1.0 | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2.0 | mozilla | 0.95 | (?:http|https) (?:www )?mozilla org (?:mpl|en us mpl) 2 0
mpl-2.0 | mozilla | 0.95 | mozilla public license (?:version |v ?)?2(?: 0)?
mpl-1.1 | mozilla | 0.95 | mozilla public license (?:version |v ?)?1 1
mpl-1.0 | mozilla | 0.95 | mozilla public license (?:version |v ?)?1 0
mpl | mozilla | 0.75 | mozilla public licen[sc]e
mpl-2.0 | mpl | 0.85 | mpl (?:v )?2 0
mpl-1.1 | mpl | 0.85 | mpl (?:v )?1 1
epl-2.0 | eclipse | 0.95 | eclipse public license (?:version |v ?)?2(?: 0)?
epl-1.0 | eclipse | 0.95 | eclipse public license (?:version |v ?)?1(?: 0)?
epl | eclipse | 0.75 | eclipse public licen[sc]e
edl-1.0 | eclipse | 0.9 | eclipse distribution license (?:version |v ?)?1 0
epl-2.0 | epl | 0.85 | epl (?:v )?2 0
epl-1.0 | epl | 0.85 | epl (?:v )?1 0
eupl-1.2 | european union | 0.95 | european union public licen[sc]e (?:version |v ?)?1 2
eupl-1.1 | european union | 0.95 | european union public licen[sc]e (?:version |v ?)?1 1
eupl | european union | 0.8 | european union public licen[sc]e
eupl-1.2 | eupl | 0.85 | eupl (?:v )?1 2
eupl | eupl | 0.6 | eupl
cddl-1.1 | common development | 0.95 | common development and distribution license (?:version |v ?)?1 1
cddl-1.0 | common development | 0.95 | common development and distribution license (?:version |v ?)?1 0
cddl | common development | 0.8 | common development and distribution licen[sc]e
cddl | cddl | 0.6 | cddl
cpl-1.0 | common public | 0.95 | common public license (?:version |v ?)?1 0
cpl | common public | 0.75 | common public licen[sc]e
cpal-1.0 | common public attribution | 0.95 | common public attribution license(?: version| v)?(?: 1 0)?
ipl-1.0 | ibm public | 0.9 | ibm public license(?: version| v)?(?: 1 0)?
cecill-2.1 | cecill | 0.9 | cecill (?:version |v ?)?2 1
cecill-b | cecill | 0.9 | cecill b
cecill-c | cecill | 0.9 | cecill c
cecill | cecill | 0.6 | cecill
artistic-2.0 | artistic | 0.95 | artistic license (?:version |v ?)?2(?: 0)?
artistic-1.0 | artistic | 0.95 | artistic license (?:version |v ?)?1(?: 0)?
artistic | artistic | 0.75 | artistic licen[sc]e
perl | same terms as perl | 0.85 | under the same terms as perl(?: itself| 5)?
python-2.0 | python software | 0.9 | python software foundation license(?: version| v)?(?: 2)?
psf | psf | 0.7 | psf licen[sc]e
ruby | ruby | 0.7 | (?:the )?ruby licen[sc]e
php-3.01 | php | 0.9 | php license (?:version |v ?)?3 01
php-3.0 | php | 0.9 | php license (?:version |v ?)?3 0
php | php | 0.7 | (?:the )?php licen[sc]e
zpl-2.1 | zope | 0.9 | zope public license(?: version| v)?(?: 2 1)?
zlib | as is without | 0.95 | this software is provided as is without any express or implied warranty in no event will the authors be held liable
zlib | zlib | 0.9 | zlib (?:libpng )?licen[sc]e
libpng | libpng | 0.85 | libpng licen[sc]e
bsl-1.0 | boost | 0.95 | (?:distributed under the )?boost software license(?: version| v)?(?: 1 0)?
bsl-1.0 | boost | 0.9 | (?:http|https) www boost org license 1 0 txt
busl-1.1 | business source | 0.95 | business source license(?: version| v)?(?: 1 1)?
sspl-1.0 | server side | 0.95 | server side public license(?: version| v)?(?: 1)?
elastic-2.0 | elastic | 0.95 | elastic license(?: version| v)?(?: 2 0)?
commons-clause | commons clause | 0.9 | commons clause(?: license)?(?: condition)?(?: v1 0)?
polyform-noncommercial | polyform | 0.9 | polyform noncommercial(?: license)?(?: 1 0 0)?
polyform-shield | polyform | 0.9 | polyform shield(?: license)?(?: 1 0 0)?
unlicense | unencumbered | 1.0 | this is free and unencumbered software released into the public domain
unlicense | unlicense | 0.85 | (?:the )?unlicense
unlicense | unlicense | 0.95 | (?:http|https) unlicense org
wtfpl | wtfpl | 0.85 | wtfpl(?: version| v)?(?: 2)?
wtfpl | do what the | 0.95 | do what the fuck you want to public license
beerware | beer | 0.85 | (?:the )?beer ?ware licen[sc]e
cc0-1.0 | creative commons | 0.95 | creative commons (?:cc0|zero)(?: v)?(?: 1 0)?(?: universal)?
cc0-1.0 | cc0 | 0.9 | cc0(?: v)?(?: 1 0)?(?: universal)?
cc0-1.0 | publicdomain | 0.95 | (?:http|https) creativecommons org publicdomain zero 1 0
pdm | publicdomain | 0.9 | (?:http|https) creativecommons org publicdomain mark 1 0
cc-by-nc-nd-4.0 | creativecommons | 0.95 | (?:http|https) (?:www )?creativecommons org licenses by nc nd 4 0
cc-by-nc-sa-4.0 | creativecommons | 0.95 | (?:http|https) (?:www )?creativecommons org licenses by nc sa 4 0
cc-by-nc-4.0 | creativecommons | 0.95 | (?:http|https) (?:www )?creativecommons org licenses by nc 4 0
cc-by-nd-4.0 | creativecommons | 0.95 | (?:http|https) (?:www )?creativecommons org licenses by nd 4 0
cc-by-sa-4.0 | creativecommons | 0.95 | (?:http|https) (?:www )?creativecommons org licenses by sa 4 0
cc-by-4.0 | creativecommons | 0.95 | (?:http|https) (?:www )?creativecommons org licenses by 4 0
cc-by-sa-3.0 | creativecommons | 0.95 | (?:http|https) (?:www )?creativecommons org licenses by sa 3 0
cc-by-3.0 | creativecommons | 0.95 | (?:http|https) (?:www )?creativecommons org licenses by 3 0
cc-by-nc-nd-4.0 | creative commons | 0.95 | creative commons attribution non ?commercial no ?deriv(?:s|atives|ative works) 4 0(?: international)?
cc-by-nc-sa-4.0 | creative commons | 0.95 | creative commons attribution non ?commercial share ?alike 4 0(?: international)?
cc-by-nc-4.0 | creative commons | 0.95 | creative commons attribution non ?commercial 4 0(?: international)?
cc-by-nd-4.0 | creative commons | 0.95 | creative commons attribution no ?deriv(?:s|atives|ative works) 4 0(?: international)?
cc-by-sa-4.0 | creative commons | 0.95 | creative commons attribution share ?alike 4 0(?: international)?
cc-by-4.0 | creative commons | 0.95 | creative commons attribution 4 0(?: international)?
cc-by-nc-nd | creative commons | 0.85 | creative commons attribution non ?commercial no ?deriv(?:s|atives|ative works)(?: license)?
cc-by-nc-sa | creative commons | 0.85 | creative commons attribution non ?commercial share ?alike(?: license)?
cc-by-nc | creative commons | 0.85 | creative commons attribution non ?commercial(?: license)?
cc-by-nd | creative commons | 0.85 | creative commons attribution no ?deriv(?:s|atives|ative works)(?: license)?
cc-by-sa | creative commons | 0.85 | creative commons attribution share ?alike(?: license)?
cc-by | creative commons | 0.8 | creative commons attribution(?: license)?
creative-commons | creative commons | 0.6 | creative commons(?: licen[sc]e)?
cc-by-nc-nd-4.0 | cc by | 0.95 | cc by nc nd 4 0
cc-by-nc-sa-4.0 | cc by | 0.95 | cc by nc sa 4 0
cc-by-nc-4.0 | cc by | 0.95 | cc by nc 4 0
cc-by-nd-4.0 | cc by | 0.95 | cc by nd 4 0
cc-by-sa-4.0 | cc by | 0.95 | cc by sa 4 0
cc-by-4.0 | cc by | 0.95 | cc by 4 0
cc-by-nc-nd-3.0 | cc by | 0.95 | cc by nc nd 3 0
cc-by-nc-sa-3.0 | cc by | 0.95 | cc by nc sa 3 0
cc-by-nc-3.0 | cc by | 0.95 | cc by nc 3 0
cc-by-sa-3.0 | cc by | 0.95 | cc by sa 3 0
cc-by-3.0 | cc by | 0.95 | cc by 3 0
cc-by-nc-nd | cc by | 0.85 | cc by nc nd
cc-by-nc-sa | cc by | 0.85 | cc by nc sa
cc-by-nc | cc by | 0.85 | cc by nc
cc-by-nd | cc by | 0.85 | cc by nd
cc-by-sa | cc by | 0.85 | cc by sa
odbl-1.0 | open database | 0.95 | open database license(?: odbl)?(?: version| v)?(?: 1 0)?
odc-by-1.0 | open data commons | 0.95 | open data commons attribution license(?: version| v)?(?: 1 0)?
pddl-1.0 | public domain dedication | 0.9 | public domain dedication and licen[sc]e(?: pddl)?(?: 1 0)?
cdla-permissive | community data | 0.9 | community data license agreement permissive(?: version)?(?: 1 0| 2 0)?
cdla-sharing | community data | 0.9 | community data license agreement sharing(?: version)?(?: 1 0)?
ogl-3.0 | open government | 0.9 | open government licen[sc]e(?: version| v)?(?: 3 0)?
ofl-1.1 | open font | 0.95 | (?:sil )?open font license(?: version| v)?(?: 1 1)?
ofl-1.1 | ofl | 0.7 | sil ofl(?: 1 1)?
ncsa | illinois | 0.95 | university of illinois ncsa open source license
ms-pl | microsoft | 0.9 | microsoft public licen[sc]e
ms-rl | microsoft | 0.9 | microsoft reciprocal licen[sc]e
osl-3.0 | open software | 0.9 | open software license(?: version| v)?(?: 3 0)?
afl-3.0 | academic free | 0.9 | academic free license(?: version| v)?(?: 3 0| 2 1)?
upl-1.0 | universal permissive | 0.9 | universal permissive license(?: version| v)?(?: 1 0)?
vim | vim | 0.7 | (?:the )?vim licen[sc]e
postgresql | postgresql | 0.8 | (?:the )?postgresql licen[sc]e
openssl | openssl | 0.8 | (?:the )?openssl licen[sc]e
curl | curl | 0.75 | (?:the )?curl licen[sc]e
ftl | freetype | 0.85 | (?:the )?freetype (?:project )?licen[sc]e
ijg | jpeg group | 0.85 | this software is based in part on the work of the independent jpeg group
w3c | w3c | 0.85 | w3c software (?:notice and )?(?:and document )?licen[sc]e
unicode | unicode | 0.85 | unicode (?:license agreement|terms of use|inc license)
nasa-1.3 | nasa | 0.85 | nasa open source agreement(?: version| v)?(?: 1 3)?
apsl-2.0 | apple | 0.85 | apple public source license(?: version| v)?(?: 2 0)?
sleepycat | sleepycat | 0.8 | sleepycat licen[sc]e
qpl-1.0 | q public | 0.85 | q public license(?: version| v)?(?: 1 0)?
lppl-1.3c | latex project | 0.85 | latex project public license(?: version| v)?(?: 1 3c?)?
blueoak-1.0.0 | blue oak | 0.9 | blue oak model license(?: 1 0 0)?
hippocratic-3.0 | hippocratic | 0.85 | hippocratic license(?: version| v)?(?: 3 0| 2 1)?
openrail | openrail | 0.85 | (?:creativeml |bigscience |bigcode )?open ?rail(?: m)?(?: license)?
llama-community | llama | 0.85 | llama(?: 2| 3)?(?: 1)? community license(?: agreement)?
mulan-psl-2.0 | mulan | 0.9 | mulan (?:psl|permissive software license)(?: version| v)?(?: 2)?
public-domain | public domain | 0.7 | (?:released|placed|dedicated) (?:in|into|to) the public domain
public-domain | public domain | 0.6 | (?:is|are) (?:in the )?public domain
freeware | freeware | 0.5 | freeware licen[sc]e
shareware | shareware | 0.5 | shareware licen[sc]e
proprietary | proprietary | 0.7 | proprietary and confidential
proprietary | unauthorized | 0.7 | unauthorized (?:copying|reproduction|distribution|use) of this (?:file|software|document|material)(?: via any medium)? is strictly prohibited
proprietary | without the prior | 0.6 | without the (?:express )?prior written (?:permission|consent)
proprietary | trade secret | 0.6 | (?:contains |is a )?trade secrets?
commercial | commercial licen | 0.6 | commercial licen[sc]e
eula | end user | 0.7 | end user licen[sc]e agreement
warranty-disclaimer | warranty | 0.4 | (?:provided )?as is without warranty of any kind(?: express or implied)?
warranty-disclaimer | warranties | 0.4 | without warranties or conditions of any kind
copyright-notice | copyright | 0.4 | copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2}(?= ))*+
copyright-notice | copyright | 0.4 | (?:c )?copyright (?:by|c)
generic-licence | licen | 0.3 | (?:licensed|released|distributed|made available) under (?:the )?(?:terms of )?(?:[^ ]+ ){0,3}?licen[sc]e
generic-licence | licen | 0.3 | see (?:the )?licen[sc]e(?: file)?(?: for details| for more information)?
"""


def _read(lines: str, first: int) -> list[Rule]:
    found = []
    for number, line in enumerate(filter(None, map(str.strip, lines.splitlines()))):
        label, keyword, strength, pattern = (part.strip() for part in line.split(" | ", 3))
        found.append(Rule(first + number, label, keyword, float(strength), pattern))
    return found


def base_rules() -> list[Rule]:
    return _read(BASE, 0)


def rules() -> list[Rule]:
    return _read(RULES, len(base_rules()))
