"""Licence signatures, strongest first.

A line is ``label; level; keyword; regex``. The regex reads the words of a text in lower
case with single spaces between them, punctuation gone, and matches whole words. The
keyword is a plain part of every text that the regex can match. Levels: 1 a declaration
(tag, grant, notice), 2 a licence by its name, 3 a reference (address, short name).
"""

from __future__ import annotations

from typing import NamedTuple

TRIGGERS = (
    "licen", "copyright", "copyleft", "public domain", "cc by", "cc0", "spdx", "gnu",
    "hereby granted", "redistribution and use", "rights reserved", "creative commons",
    "without warranty", "implied warranty", "advertising materials", "endorse or promote",
    "creativecommons", "mozilla org mpl", "proprietary and confidential",
)
"""Every keyword has one of these; a text without any is not looked at further."""

BASE = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)
"""Label and phrase of the places that are always reported."""

_TABLE = r"""
0bsd; 1; spdx licen; spdx license identifier 0bsd
afl-3.0; 1; spdx licen; spdx license identifier afl 3 0
agpl-3.0; 1; spdx licen; spdx license identifier agpl 3 0( only| or later)?
apache-1.1; 1; spdx licen; spdx license identifier apache 1 1
apache-2.0; 1; spdx licen; spdx license identifier apache 2 0
apache-2.0 with llvm-exception; 1; spdx licen; spdx license identifier apache 2 0 with llvm exception
artistic-2.0; 1; spdx licen; spdx license identifier artistic 2 0
blueoak-1.0.0; 1; spdx licen; spdx license identifier blueoak 1 0 0
bsd-2-clause; 1; spdx licen; spdx license identifier bsd 2 clause
bsd-2-clause-patent; 1; spdx licen; spdx license identifier bsd 2 clause patent
bsd-3-clause; 1; spdx licen; spdx license identifier bsd 3 clause
bsd-3-clause-clear; 1; spdx licen; spdx license identifier bsd 3 clause clear
bsd-4-clause; 1; spdx licen; spdx license identifier bsd 4 clause
bsl-1.0; 1; spdx licen; spdx license identifier bsl 1 0
busl-1.1; 1; spdx licen; spdx license identifier busl 1 1
cc0-1.0; 1; spdx licen; spdx license identifier cc0 1 0
cc-by-3.0; 1; spdx licen; spdx license identifier cc by 3 0
cc-by-4.0; 1; spdx licen; spdx license identifier cc by 4 0
cc-by-sa-3.0; 1; spdx licen; spdx license identifier cc by sa 3 0
cc-by-sa-4.0; 1; spdx licen; spdx license identifier cc by sa 4 0
cc-by-nc-4.0; 1; spdx licen; spdx license identifier cc by nc 4 0
cc-by-nd-4.0; 1; spdx licen; spdx license identifier cc by nd 4 0
cc-by-nc-sa-4.0; 1; spdx licen; spdx license identifier cc by nc sa 4 0
cc-by-nc-nd-4.0; 1; spdx licen; spdx license identifier cc by nc nd 4 0
cddl-1.0; 1; spdx licen; spdx license identifier cddl 1 0
cddl-1.1; 1; spdx licen; spdx license identifier cddl 1 1
cecill-2.1; 1; spdx licen; spdx license identifier cecill 2 1
cpl-1.0; 1; spdx licen; spdx license identifier cpl 1 0
ecl-2.0; 1; spdx licen; spdx license identifier ecl 2 0
epl-1.0; 1; spdx licen; spdx license identifier epl 1 0
epl-2.0; 1; spdx licen; spdx license identifier epl 2 0
eupl-1.2; 1; spdx licen; spdx license identifier eupl 1 2
gfdl-1.3; 1; spdx licen; spdx license identifier gfdl 1 3( only| or later)?
gpl-2.0; 1; spdx licen; spdx license identifier gpl 2 0( only| or later)?
gpl-2.0 with classpath-exception; 1; spdx licen; spdx license identifier gpl 2 0( only| or later)? with classpath exception 2 0
gpl-3.0; 1; spdx licen; spdx license identifier gpl 3 0( only| or later)?
isc; 1; spdx licen; spdx license identifier isc
lgpl-2.1; 1; spdx licen; spdx license identifier lgpl 2 1( only| or later)?
lgpl-3.0; 1; spdx licen; spdx license identifier lgpl 3 0( only| or later)?
mit; 1; spdx licen; spdx license identifier mit
mit-0; 1; spdx licen; spdx license identifier mit 0
mpl-1.1; 1; spdx licen; spdx license identifier mpl 1 1
mpl-2.0; 1; spdx licen; spdx license identifier mpl 2 0
ms-pl; 1; spdx licen; spdx license identifier ms pl
ncsa; 1; spdx licen; spdx license identifier ncsa
odbl-1.0; 1; spdx licen; spdx license identifier odbl 1 0
ofl-1.1; 1; spdx licen; spdx license identifier ofl 1 1
openssl; 1; spdx licen; spdx license identifier openssl
osl-3.0; 1; spdx licen; spdx license identifier osl 3 0
postgresql; 1; spdx licen; spdx license identifier postgresql
psf-2.0; 1; spdx licen; spdx license identifier (psf|python) 2 0
unlicense; 1; spdx licen; spdx license identifier unlicense
upl-1.0; 1; spdx licen; spdx license identifier upl 1 0
vim; 1; spdx licen; spdx license identifier vim
w3c; 1; spdx licen; spdx license identifier w3c
wtfpl; 1; spdx licen; spdx license identifier wtfpl
x11; 1; spdx licen; spdx license identifier x11
zlib; 1; spdx licen; spdx license identifier zlib
zpl-2.1; 1; spdx licen; spdx license identifier zpl 2 1
agpl-3.0; 1; gnu affero general public licen; under the( terms of the)? gnu affero general public license( as published by the free software foundation)?( either)? (version|v) 3( 0)?( of the license)?( only| or( at your option)? any later version| or later)?
agpl-3.0; 2; affero general public licen; (gnu )?affero general public license (version 3|v3)( 0)?
agpl; 2; affero general public licen; (gnu )?affero general public license
agpl-3.0; 3; gnu org licenses agpl; gnu org licenses agpl( 3 0)?( html| txt)?
gpl-1.0; 1; gnu general public licen; under the( terms of the)? gnu general public license (version|v) 1( 0)?
gpl-2.0; 1; gnu general public licen; under the( terms of the)? gnu general public license( as published by the free software foundation)?( either)? (version|v) 2( 0)?( of the license)?
gpl-2.0-or-later; 1; gnu general public licen; under the( terms of the)? gnu general public license as published by the free software foundation either version 2 of the license or( at your option)? any later version
gpl-3.0; 1; gnu general public licen; under the( terms of the)? gnu general public license( as published by the free software foundation)?( either)? (version|v) 3( 0)?( of the license)?
gpl-3.0-or-later; 1; gnu general public licen; under the( terms of the)? gnu general public license as published by the free software foundation either version 3 of the license or( at your option)? any later version
gpl; 1; gnu general public licen; (licensed|released|distributed|available) under the( terms of the)? gnu general public license
gpl-1.0; 2; general public licen; (gnu )?general public license (version |v ?)1( 0)?
gpl-2.0; 2; general public licen; (gnu )?general public license (version |v ?)2( 0)?
gpl-3.0; 2; general public licen; (gnu )?general public license (version |v ?)3( 0)?
gpl; 2; gnu general public licen; gnu general public license
gpl; 2; gnu public licen; gnu public license
gpl; 2; gnu gpl; gnu gpl
gpl-2.0; 2; gnu gpl; gnu gpl ?v ?2( 0)?
gpl-3.0; 2; gnu gpl; gnu gpl ?v ?3( 0)?
gpl; 3; gnu org licenses; gnu org licenses (gpl|old licenses gpl)( 2 0| 3 0)?( html| txt)?
gpl; 3; licensed under gpl; licensed under gpl
gpl-2.0; 3; licen; license(d under)?( the)? gpl ?v?2( 0)?
gpl-3.0; 3; licen; license(d under)?( the)? gpl ?v?3( 0)?
lgpl-2.0; 1; library general public licen; under the( terms of the)? gnu library general public license( as published by the free software foundation)?( either)? version 2( 0)?
lgpl-2.1; 1; lesser general public licen; under the( terms of the)? gnu lesser general public license( as published by the free software foundation)?( either)? (version|v) 2 1
lgpl-3.0; 1; lesser general public licen; under the( terms of the)? gnu lesser general public license( as published by the free software foundation)?( either)? (version|v) 3( 0)?
lgpl-2.1; 2; lesser general public licen; (gnu )?lesser general public license (version |v ?)2 1
lgpl-3.0; 2; lesser general public licen; (gnu )?lesser general public license (version |v ?)3( 0)?
lgpl; 2; general public licen; (gnu )?(lesser|library) general public license
lgpl; 3; gnu lgpl; gnu lgpl( v?[23])?( 1| 0)?
lgpl; 3; gnu org licenses; gnu org licenses (lgpl|old licenses lgpl)( 2 1| 3 0)?( html| txt)?
gfdl; 2; gnu free documentation licen; gnu free documentation license
gfdl-1.2; 2; gnu free documentation licen; gnu free documentation license version 1 2
gfdl-1.3; 2; gnu free documentation licen; gnu free documentation license version 1 3
gfdl; 3; gnu fdl; gnu fdl
apache-1.0; 1; apache; licensed under the apache( software)? license version 1 0
apache-1.1; 1; apache software licen; (licensed )?under the apache software license version 1 1
apache-2.0; 1; apache licen; licensed under the apache license version 2( 0)?
apache-2.0; 1; apache licen; licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
apache-2.0 with llvm-exception; 1; apache licen; under the apache license v ?2 0 with llvm exceptions?
apache; 1; apache licen; (licensed|released|distributed|available) under the( terms of the)? apache license
apache-2.0; 2; apache licen; apache license (version |v ?)?2( 0)?
apache-1.1; 2; apache; apache( software)? license (version |v ?)1 1
apache; 2; apache licen; apache license
apache; 2; apache software licen; apache software license
apache-2.0; 2; apache 2; apache 2( 0)? licensed?
apache-2.0; 3; apache org licenses; apache org licenses license 2 0( txt| html)?
mit; 1; permission is hereby granted; permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit-0; 1; permission is hereby granted; permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided as is
mit; 1; mit licen; (licensed|released|distributed|available|published) under the( terms of the)? mit license
mit; 2; mit licen; (the )?mit licen[sc]e
mit-0; 2; mit no attribution; mit no attribution license
mit; 2; mit x11 licen; mit x11 license
mit; 2; expat licen; (mit )?expat license
mit; 3; opensource org licenses mit; opensource org licenses mit( license)?( php| html)?
mit; 3; mit licensed; mit licensed
x11; 2; x11 licen; x11 license
isc; 1; permission to use copy modify and or distribute; permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice
0bsd; 1; hereby granted; permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is
isc; 2; isc licen; (the )?isc license
0bsd; 2; zero clause bsd; (bsd )?zero clause bsd license
isc; 3; opensource org licenses isc; opensource org licenses isc( license)?( txt)?
bsd; 1; redistribution and use; redistribution and use in source and binary forms with or without modification are permitted( provided that the following conditions are met)?
bsd; 1; bsd; (licensed|released|distributed|available) under (the|a)( terms of the)? (bsd|bsd style) license
bsd-4-clause; 1; all advertising materials mentioning features; all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd-3-clause; 1; to endorse or promote products; may be used to endorse or promote products derived from this software without specific prior written permission
bsd-2-clause; 2; 2 clause; (bsd 2 clause|2 clause bsd)( simplified)? license
bsd-3-clause; 2; 3 clause; (bsd 3 clause|3 clause bsd)( new| revised)?( or revised)? license
bsd-4-clause; 2; 4 clause; (bsd 4 clause|4 clause bsd)( original)? license
bsd-2-clause; 2; bsd licen; (simplified|freebsd|free) bsd license
bsd-3-clause; 2; bsd licen; (new|modified|revised) bsd license
bsd-4-clause; 2; bsd licen; (original|old) bsd license
bsd; 2; bsd licen; bsd licen[sc]e
bsd; 2; bsd style licen; bsd style license
bsd-2-clause; 3; opensource org licenses bsd; opensource org licenses bsd 2 clause
bsd-3-clause; 3; opensource org licenses bsd; opensource org licenses bsd 3 clause
bsd; 3; opensource org licenses bsd; opensource org licenses bsd license( php)?
bsd-protection; 2; bsd protection licen; bsd protection license
cc0-1.0; 1; public domain; (dedicated|released|placed) (to|into|in) the public domain (under|using|via) (the )?(cc0|creative commons zero)( 1 0)?
cc0-1.0; 2; cc0; cc0 1 0( universal)?( license| public domain dedication)?
cc0-1.0; 2; creative commons; creative commons (zero|cc0)( v?1 0)?( universal)?
cc0; 2; cc0; cc0 license
cc0-1.0; 3; publicdomain zero; creativecommons org publicdomain zero 1 0
cc-by-1.0; 2; cc by; cc by 1 0
cc-by-2.0; 2; cc by; cc by 2 0
cc-by-2.5; 2; cc by; cc by 2 5
cc-by-3.0; 2; cc by; cc by 3 0
cc-by-4.0; 2; cc by; cc by 4 0
cc-by-sa-2.0; 2; cc by sa; cc by sa 2 0
cc-by-sa-3.0; 2; cc by sa; cc by sa 3 0
cc-by-sa-4.0; 2; cc by sa; cc by sa 4 0
cc-by-nc-2.0; 2; cc by nc; cc by nc 2 0
cc-by-nc-3.0; 2; cc by nc; cc by nc 3 0
cc-by-nc-4.0; 2; cc by nc; cc by nc 4 0
cc-by-nd-3.0; 2; cc by nd; cc by nd 3 0
cc-by-nd-4.0; 2; cc by nd; cc by nd 4 0
cc-by-nc-sa-3.0; 2; cc by nc sa; cc by nc sa 3 0
cc-by-nc-sa-4.0; 2; cc by nc sa; cc by nc sa 4 0
cc-by-nc-nd-3.0; 2; cc by nc nd; cc by nc nd 3 0
cc-by-nc-nd-4.0; 2; cc by nc nd; cc by nc nd 4 0
cc-by-sa; 2; cc by sa; cc by sa
cc-by-nc; 2; cc by nc; cc by nc
cc-by-nd; 2; cc by nd; cc by nd
cc-by-nc-sa; 2; cc by nc sa; cc by nc sa
cc-by-nc-nd; 2; cc by nc nd; cc by nc nd
cc-by; 2; cc by; cc by
cc-by; 1; creative commons attribution; (licensed|released|distributed|available) under (a|the) creative commons attribution( 4 0| 3 0| 2 0)?( international| unported| generic)? license
cc-by-sa; 1; creative commons attribution share; (licensed|released|distributed|available) under (a|the) creative commons attribution share ?alike( 4 0| 3 0| 2 0)?( international| unported| generic)? license
cc-by-nc; 1; creative commons attribution non; (licensed|released|distributed|available) under (a|the) creative commons attribution non ?commercial( 4 0| 3 0| 2 0)?( international| unported| generic)? license
cc-by-nd; 1; creative commons attribution no; (licensed|released|distributed|available) under (a|the) creative commons attribution no ?deriv(ative)?s?( works)?( 4 0| 3 0| 2 0)?( international| unported| generic)? license
cc-by-4.0; 2; creative commons attribution; creative commons attribution 4 0( international)?( license| public license)?
cc-by-3.0; 2; creative commons attribution; creative commons attribution 3 0( unported)?( license)?
cc-by-sa-4.0; 2; creative commons attribution share; creative commons attribution share ?alike 4 0( international)?( license| public license)?
cc-by-sa-3.0; 2; creative commons attribution share; creative commons attribution share ?alike 3 0( unported)?( license)?
cc-by-sa; 2; creative commons attribution share; creative commons attribution share ?alike
cc-by-nc-4.0; 2; creative commons attribution non; creative commons attribution non ?commercial 4 0( international)?
cc-by-nc; 2; creative commons attribution non; creative commons attribution non ?commercial
cc-by-nc-sa; 2; creative commons attribution non; creative commons attribution non ?commercial share ?alike
cc-by-nc-nd; 2; creative commons attribution non; creative commons attribution non ?commercial no ?deriv(ative)?s?
cc-by; 2; creative commons attribution; creative commons attribution( license)?
cc-by-4.0; 3; creativecommons org licenses by; creativecommons org licenses by 4 0
cc-by-3.0; 3; creativecommons org licenses by; creativecommons org licenses by 3 0
cc-by-sa-4.0; 3; creativecommons org licenses by sa; creativecommons org licenses by sa 4 0
cc-by-sa-3.0; 3; creativecommons org licenses by sa; creativecommons org licenses by sa 3 0
cc-by-nc-4.0; 3; creativecommons org licenses by nc; creativecommons org licenses by nc 4 0
cc-by-nc-sa-4.0; 3; creativecommons org licenses by nc sa; creativecommons org licenses by nc sa 4 0
cc-by-nc-nd-4.0; 3; creativecommons org licenses by nc nd; creativecommons org licenses by nc nd 4 0
mpl-1.0; 2; mozilla public licen; mozilla public license (version |v ?)1 0
mpl-1.1; 2; mozilla public licen; mozilla public license (version |v ?)?1 1
mpl-2.0; 2; mozilla public licen; mozilla public license (version |v ?)?2( 0)?
mpl-2.0; 1; mozilla public licen; subject to the terms of the mozilla public license v 2 0
mpl; 2; mozilla public licen; mozilla public license
mpl-2.0; 3; mozilla org mpl; mozilla org mpl 2 0
epl-1.0; 2; eclipse public licen; eclipse public license (version |v ?)?1 0
epl-2.0; 2; eclipse public licen; eclipse public license (version |v ?)?2 0
epl; 2; eclipse public licen; eclipse public license
edl-1.0; 2; eclipse distribution licen; eclipse distribution license( version 1 0| v 1 0)?
cpl-1.0; 2; common public licen; common public license( version 1 0| v 1 0)?
cddl; 2; common development and distribution licen; common development and distribution license( version 1 [01])?
artistic-1.0; 2; artistic licen; artistic license (version )?1 0
artistic-2.0; 2; artistic licen; artistic license (version )?2 0
artistic; 2; artistic licen; (perl )?artistic license
bsl-1.0; 1; boost software licen; (distributed|licensed) under the boost software license( version 1 0)?
bsl-1.0; 2; boost software licen; boost software license( version 1 0)?
busl-1.1; 2; business source licen; business source license( version)?( 1 1)?
sspl-1.0; 2; server side public licen; server side public license( version 1| v1)?
elastic-2.0; 2; elastic licen; elastic license( version)?( 2 0)?
commons-clause; 2; commons clause; commons clause license condition( v?1 0)?
polyform; 2; polyform; polyform (noncommercial|small business|shield|strict) license( 1 0 0)?
unlicense; 1; released into the public domain; this is free and unencumbered software released into the public domain
unlicense; 2; unlicen; the unlicense
unlicense; 3; unlicense org; unlicense org
wtfpl; 2; public licen; do what the (fuck|f) you want to public license( version 2)?
wtfpl; 3; wtfpl licen; wtfpl license
zlib; 1; this software is provided as is without any express or implied warranty; this software is provided as is without any express or implied warranty in no event will the authors be held liable
zlib; 2; zlib; zlib( libpng)? license
libpng; 2; libpng licen; libpng license
ofl-1.1; 2; open font licen; (sil )?open font license( version 1 1| 1 1)?
odbl-1.0; 2; open database licen; open (data commons open )?database license( v?1 0)?
odc-by-1.0; 2; open data commons attribution licen; open data commons attribution license( v?1 0)?
pddl-1.0; 2; public domain dedication and licen; (open data commons )?public domain dedication and license
eupl; 2; european union public licen; european union public licen[sc]e( v ?1 [012]| version 1 [012])?
osl-3.0; 2; open software licen; open software license( version)?( v ?)?( ?3 0)?
afl; 2; academic free licen; academic free license( version)?( v ?)?( ?[23] [01])?
ecl-2.0; 2; educational community licen; educational community license( version 2 0)?
ncsa; 2; open source licen; university of illinois( ncsa)? open source license
psf; 2; python software foundation licen; python software foundation license( version 2)?
php; 2; php licen; php license( version)?( 3 0| 3 01)?
ruby; 2; ruby licen; ruby license
openssl; 2; openssl licen; openssl license
postgresql; 2; postgresql licen; postgresql licen[sc]e
ms-pl; 2; microsoft public licen; microsoft public license
ms-rl; 2; microsoft reciprocal licen; microsoft reciprocal license
zpl; 2; zope public licen; zope public license( version)?( 2 [01])?
w3c; 2; w3c software; w3c software( and document)?( notice and)? license
upl-1.0; 2; universal permissive licen; universal permissive license( v ?1 0)?
vim; 2; vim licen; vim license
ipl-1.0; 2; ibm public licen; ibm public license( version 1 0)?
sun; 2; sun public licen; sun public license
qpl-1.0; 2; q public licen; q public license( version 1 0)?
cecill; 2; cecill; cecill( b| c)? (free software )?license
blueoak-1.0.0; 2; blue oak model licen; blue oak model license( 1 0 0)?
openrail; 2; rail; (open|creativeml open|bigscience) ?rail( m)? license
llama; 2; community licen; llama [23]( 1| 2)? community license( agreement)?
gpl; 2; copyleft; gpl copyleft
copyleft; 3; copyleft; (strong|weak) copyleft licen[sc]e
public-domain; 1; public domain; (dedicated|released|placed) (to|into|in) the public domain
public-domain; 2; public domain; in the public domain
proprietary; 2; all rights reserved; all rights reserved
proprietary; 2; proprietary licen; proprietary license
proprietary; 1; is strictly prohibited proprietary and confidential; (unauthorized )?(copying|reproduction) of this (file|document|software)( via any medium)? is strictly prohibited proprietary and confidential
copyright; 3; copyright; copyright( c)?( (19|20)[0-9]{2})+( present)?
no-warranty; 3; without warranty; without warranty of any kind
"""  # fmt: skip


class Rule(NamedTuple):
    label: str
    level: int
    keyword: str
    regex: str


def _read(table: str) -> tuple[Rule, ...]:
    rows = (line.split("; ", 3) for line in table.strip().splitlines())
    return tuple(Rule(label, int(level), keyword, regex) for label, level, keyword, regex in rows)


RULES = _read(_TABLE)
LEVELS = {1: 1.0, 2: 0.8, 3: 0.5}
"""Certainty of a detection by its level."""
