"""Signature rules of the license scan, written by hand.

A line is ``priority | label | keyword | expression``. The expression is matched against the words of a text, lower-cased
and one space apart, from the beginning of a word to the end of one; "2.0" is the words "2 0". The keyword begins a
word of everything the expression matches: a text without it is not searched. Priority 1 is an identifier or a text
that only this license has, 2 a name with its version, 3 a name, 4 a hint that there are terms at all.
"""

from __future__ import annotations

import re
from typing import NamedTuple

#: Labels of the base rules: their places are counted, and their labels are never suppressed.
BASE = ("mit", "apache", "gpl")
#: Confidence by priority.
CONFIDENCE = {1: 0.95, 2: 0.85, 3: 0.6, 4: 0.25}

_BASE_RULES = """
3 | mit | licen | mit license
3 | apache | licen | apache license
3 | gpl | licen | general public license
"""

_RULES = """
1 | apache-2.0 | licen | licensed under the apache license version 2 0(?: the license)?
1 | apache-2.0 | licen | you may not use this file except in compliance with the license you may obtain a copy of the license at
1 | apache-2.0 | spdx | spdx license identifier apache 2 0
1 | apache-1.1 | spdx | spdx license identifier apache 1 1
1 | apache-1.0 | spdx | spdx license identifier apache 1 0
1 | apache-2.0 | licen | (?:https? )?(?:www )?apache org licenses license 2 0(?: txt| html)?
2 | apache-2.0 | licen | apache (?:software |public )?licen[cs]e (?:version |v |ver )?2(?: 0)?
2 | apache-2.0 | licen | apache (?:software |public )?licen[cs]e v2(?: 0)?
2 | apache-2.0 | licen | apache 2(?: 0)? licen[cs]ed?
2 | apache-1.1 | licen | apache (?:software )?licen[cs]e (?:version |v )?1 1
2 | apache-1.0 | licen | apache (?:software )?licen[cs]e (?:version |v )?1 0
2 | apache-2.0 | licen | licen[cs]e apache 2(?: 0)?
2 | apache-1.1 | apache | this product includes software developed by the apache software foundation
3 | apache-unversioned | licen | apache (?:software |public )?licen[cs]ed?
4 | apache-unversioned | licen | licensed to the apache software foundation
1 | mit | permission | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files(?: the software)?
1 | mit | licen | released under the mit license
1 | mit | spdx | spdx license identifier mit
1 | mit | licen | (?:https? )?(?:www )?opensource org licenses mit(?: license)?(?: php| html)?
1 | mit-0 | spdx | spdx license identifier mit 0
2 | mit-0 | attribution | mit no attribution(?: licen[cs]e)?
2 | mit-0 | licen | mit 0 licen[cs]e
2 | mit | licen | (?:the )?mit x11 licen[cs]e
2 | mit | licen | mit style licen[cs]e
2 | mit | licen | mit licensed
2 | mit | licen | licen[cs]e mit
2 | mit | licen | licensed under (?:the )?(?:terms of (?:the )?)?mit
2 | expat | licen | expat licen[cs]e
2 | x11 | licen | x11 licen[cs]e
2 | x11 | consortium | except as contained in this notice the name of the x consortium shall not be used
2 | mit-modern | licen | modern mit licen[cs]e
2 | mit-feh | licen | feh licen[cs]e
1 | gpl-3.0-or-later | spdx | spdx license identifier gpl 3 0 or later
1 | gpl-3.0-only | spdx | spdx license identifier gpl 3 0(?: only)?
1 | gpl-2.0-or-later | spdx | spdx license identifier gpl 2 0 or later
1 | gpl-2.0-only | spdx | spdx license identifier gpl 2 0(?: only)?
1 | gpl-1.0-or-later | spdx | spdx license identifier gpl 1 0 or later
1 | gpl-1.0-only | spdx | spdx license identifier gpl 1 0(?: only)?
1 | gpl-3.0-or-later | licen | gnu general public license as published by the free software foundation either version 3 of the license or (?:at your option )?any later version
1 | gpl-2.0-or-later | licen | gnu general public license as published by the free software foundation either version 2 of the license or (?:at your option )?any later version
1 | gpl-1.0-or-later | licen | gnu general public license as published by the free software foundation either version 1 of the license or (?:at your option )?any later version
1 | gpl-3.0 | licen | licensed under the gnu general public license version 3
1 | gpl-2.0 | licen | licensed under the gnu general public license version 2
2 | gpl-3.0-or-later | licen | (?:gnu )?general public license (?:version |v |ver )?3(?: 0)? or (?:any )?later
2 | gpl-2.0-or-later | licen | (?:gnu )?general public license (?:version |v |ver )?2(?: 0)? or (?:any )?later
2 | gpl-3.0 | licen | (?:gnu )?general public license (?:version |v |ver )?3(?: 0)?
2 | gpl-2.0 | licen | (?:gnu )?general public license (?:version |v |ver )?2(?: 0)?
2 | gpl-1.0 | licen | (?:gnu )?general public license (?:version |v |ver )?1(?: 0)?
2 | gpl-3.0 | licen | (?:gnu )?general public license v3(?: 0)?
2 | gpl-2.0 | licen | (?:gnu )?general public license v2(?: 0)?
2 | gpl-3.0 | licen | version 3 of the gnu general public license
2 | gpl-2.0 | licen | version 2 of the gnu general public license
2 | gpl-3.0-or-later | gpl | gpl (?:version |v )?3(?: 0)? or (?:any )?later
2 | gpl-2.0-or-later | gpl | gpl (?:version |v )?2(?: 0)? or (?:any )?later
2 | gpl-3.0 | gpl | (?:gnu )?gpl (?:version |v )?3(?: 0)?
2 | gpl-2.0 | gpl | (?:gnu )?gpl (?:version |v )?2(?: 0)?
2 | gpl-3.0 | gpl | (?:gnu )?gplv3(?: 0)?
2 | gpl-2.0 | gpl | (?:gnu )?gplv2(?: 0)?
2 | gpl-classpath-exception | licen | general public license.{0,60}classpath exception
2 | gpl-classpath-exception | gpl | gpl.{0,40}classpath exception
2 | gpl-linking-exception | licen | general public license.{0,60}linking exception
2 | gpl-linking-exception | gpl | gpl.{0,40}linking exception
2 | gpl-gcc-exception | gpl | gpl.{0,40}gcc (?:runtime library )?exception
2 | gpl-font-exception | gpl | gpl.{0,40}font (?:embedding )?exception
2 | gpl-bison-exception | gpl | gpl.{0,40}bison exception
3 | gpl | licen | (?:gnu )?general public licen[cs]e
3 | gpl | gpl | gnu gpl
3 | gpl | gpl | licensed under (?:the )?gpl
3 | gpl | licen | gpl licensed?
1 | lgpl-3.0-or-later | spdx | spdx license identifier lgpl 3 0 or later
1 | lgpl-3.0-only | spdx | spdx license identifier lgpl 3 0(?: only)?
1 | lgpl-2.1-or-later | spdx | spdx license identifier lgpl 2 1 or later
1 | lgpl-2.1-only | spdx | spdx license identifier lgpl 2 1(?: only)?
1 | lgpl-2.0-or-later | spdx | spdx license identifier lgpl 2 0 or later
1 | lgpl-2.0-only | spdx | spdx license identifier lgpl 2 0(?: only)?
2 | lgpl-3.0 | licen | (?:gnu )?lesser general public license (?:version |v |ver )?3(?: 0)?
2 | lgpl-2.1 | licen | (?:gnu )?lesser general public license (?:version |v |ver )?2 1
2 | lgpl-2.0 | licen | (?:gnu )?library general public license (?:version |v |ver )?2(?: 0)?
2 | lgpl-3.0 | lgpl | lgpl (?:version |v )?3(?: 0)?
2 | lgpl-2.1 | lgpl | lgpl (?:version |v )?2 1
2 | lgpl-2.0 | lgpl | lgpl (?:version |v )?2(?: 0)?
2 | lgpl-3.0 | lgpl | lgplv3
2 | lgpl-2.1 | lgpl | lgplv2 1
3 | lgpl | licen | (?:gnu )?(?:lesser|library) general public licen[cs]e
3 | lgpl | lgpl | (?:gnu )?lgpl
1 | agpl-3.0-or-later | spdx | spdx license identifier agpl 3 0 or later
1 | agpl-3.0-only | spdx | spdx license identifier agpl 3 0(?: only)?
1 | agpl-1.0 | spdx | spdx license identifier agpl 1 0(?: only| or later)?
2 | agpl-3.0 | licen | (?:gnu )?affero general public license (?:version |v |ver )?3(?: 0)?
2 | agpl-1.0 | licen | affero general public license (?:version |v |ver )?1(?: 0)?
2 | agpl-3.0 | agpl | agpl (?:version |v )?3(?: 0)?
2 | agpl-3.0 | agpl | agplv3
3 | agpl | licen | (?:gnu )?affero general public licen[cs]e
3 | agpl | agpl | (?:gnu )?agpl
1 | gfdl-1.3 | spdx | spdx license identifier gfdl 1 3(?: only| or later)?
1 | gfdl-1.2 | spdx | spdx license identifier gfdl 1 2(?: only| or later)?
1 | gfdl-1.1 | spdx | spdx license identifier gfdl 1 1(?: only| or later)?
1 | gfdl | permission | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
2 | gfdl-1.3 | licen | (?:gnu )?free documentation license version 1 3
2 | gfdl-1.2 | licen | (?:gnu )?free documentation license version 1 2
2 | gfdl-1.1 | licen | (?:gnu )?free documentation license version 1 1
3 | gfdl | licen | (?:gnu )?free documentation licen[cs]e
3 | gfdl | gfdl | (?:gnu )?gfdl
1 | bsd-3-clause | spdx | spdx license identifier bsd 3 clause
1 | bsd-2-clause | spdx | spdx license identifier bsd 2 clause
1 | bsd-4-clause | spdx | spdx license identifier bsd 4 clause
1 | bsd-1-clause | spdx | spdx license identifier bsd 1 clause
1 | 0bsd | spdx | spdx license identifier 0bsd
1 | bsd-3-clause-clear | spdx | spdx license identifier bsd 3 clause clear
1 | bsd-new | redistribut | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met.{0,900}neither the name of
1 | bsd | redistribut | redistribution and use in source and binary forms with or without modification are permitted(?: provided that the following conditions are met)?
1 | bsd-4-clause | redistribut | redistribution and use in source and binary forms.{0,900}all advertising materials mentioning features or use of this software must display the following
2 | bsd-3-clause | licen | (?:bsd )?3 clause (?:bsd )?licen[cs]e
2 | bsd-2-clause | licen | (?:bsd )?2 clause (?:bsd )?licen[cs]e
2 | bsd-4-clause | licen | (?:bsd )?4 clause (?:bsd )?licen[cs]e
2 | bsd-3-clause | licen | (?:new|modified|revised) bsd licen[cs]e
2 | bsd-2-clause | licen | (?:simplified bsd|freebsd) licen[cs]e
2 | bsd-4-clause | licen | (?:original|old) bsd licen[cs]e
2 | 0bsd | licen | (?:zero|0) clause bsd licen[cs]e
2 | bsd-patent | licen | bsd (?:2 clause )?plus patent licen[cs]e
3 | bsd | licen | bsd (?:style )?licen[cs]ed?
3 | bsd | licen | licensed under (?:the )?bsd
1 | isc | permission | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
1 | isc | spdx | spdx license identifier isc
2 | isc | licen | isc licen[cs]e
2 | isc | licen | internet systems consortium licen[cs]e
1 | mpl-2.0 | licen | this source code form is subject to the terms of the mozilla public license v 2 0
1 | mpl-2.0 | spdx | spdx license identifier mpl 2 0
1 | mpl-1.1 | spdx | spdx license identifier mpl 1 1
1 | mpl-1.0 | spdx | spdx license identifier mpl 1 0
2 | mpl-2.0 | licen | mozilla public license (?:version |v |ver )?2(?: 0)?
2 | mpl-1.1 | licen | mozilla public license (?:version |v |ver )?1 1
2 | mpl-1.0 | licen | mozilla public license (?:version |v |ver )?1 0
3 | mpl | licen | mozilla public licen[cs]e
3 | npl | licen | netscape public licen[cs]e
1 | epl-2.0 | spdx | spdx license identifier epl 2 0
1 | epl-1.0 | spdx | spdx license identifier epl 1 0
2 | epl-2.0 | licen | eclipse public license (?:version |v )?2(?: 0)?
2 | epl-1.0 | licen | eclipse public license (?:version |v )?1(?: 0)?
3 | epl | licen | eclipse public licen[cs]e
2 | edl-1.0 | licen | eclipse distribution license (?:version |v )?1(?: 0)?
3 | edl | licen | eclipse distribution licen[cs]e
1 | cddl-1.0 | spdx | spdx license identifier cddl 1 0
1 | cddl-1.1 | spdx | spdx license identifier cddl 1 1
2 | cddl-1.0 | licen | common development and distribution license (?:cddl )?(?:version |v )?1 0
2 | cddl-1.1 | licen | common development and distribution license (?:cddl )?(?:version |v )?1 1
3 | cddl | licen | common development and distribution licen[cs]e
2 | cpl-1.0 | licen | common public license (?:version |v )?1 0
3 | cpl | licen | common public licen[cs]e
2 | cpal-1.0 | licen | common public attribution license (?:version |v )?1 0
3 | cpal | licen | common public attribution licen[cs]e
2 | ipl-1.0 | licen | ibm public license (?:version |v )?1 0
3 | ipl | licen | ibm public licen[cs]e
1 | cc0-1.0 | spdx | spdx license identifier cc0 1 0
1 | cc0-1.0 | rights | (?:the person who associated a work with this deed has dedicated the work to the public domain by waiving )?all of his or her rights to the work worldwide under copyright law
2 | cc0-1.0 | cc0 | cc0 1 0(?: universal)?
2 | cc0-1.0 | commons | creative commons (?:cc0|zero)(?: 1 0)?(?: universal)?
2 | cc0-1.0 | cc | cc zero
3 | cc0 | cc0 | cc0
1 | cc-by-4.0 | spdx | spdx license identifier cc by 4 0
1 | cc-by-sa-4.0 | spdx | spdx license identifier cc by sa 4 0
1 | cc-by-nc-4.0 | spdx | spdx license identifier cc by nc 4 0
1 | cc-by-nd-4.0 | spdx | spdx license identifier cc by nd 4 0
1 | cc-by-nc-sa-4.0 | spdx | spdx license identifier cc by nc sa 4 0
1 | cc-by-nc-nd-4.0 | spdx | spdx license identifier cc by nc nd 4 0
2 | cc-by-4.0 | cc | cc by 4 0
2 | cc-by-3.0 | cc | cc by 3 0
2 | cc-by-2.5 | cc | cc by 2 5
2 | cc-by-2.0 | cc | cc by 2 0
2 | cc-by-sa-4.0 | cc | cc by sa 4 0
2 | cc-by-sa-3.0 | cc | cc by sa 3 0
2 | cc-by-sa-2.5 | cc | cc by sa 2 5
2 | cc-by-sa-2.0 | cc | cc by sa 2 0
2 | cc-by-nc-4.0 | cc | cc by nc 4 0
2 | cc-by-nc-3.0 | cc | cc by nc 3 0
2 | cc-by-nc-2.5 | cc | cc by nc 2 5
2 | cc-by-nc-2.0 | cc | cc by nc 2 0
2 | cc-by-nd-4.0 | cc | cc by nd 4 0
2 | cc-by-nd-3.0 | cc | cc by nd 3 0
2 | cc-by-nd-2.0 | cc | cc by nd 2 0
2 | cc-by-nc-sa-4.0 | cc | cc by nc sa 4 0
2 | cc-by-nc-sa-3.0 | cc | cc by nc sa 3 0
2 | cc-by-nc-sa-2.0 | cc | cc by nc sa 2 0
2 | cc-by-nc-nd-4.0 | cc | cc by nc nd 4 0
2 | cc-by-nc-nd-3.0 | cc | cc by nc nd 3 0
2 | cc-by-nc-nd-2.0 | cc | cc by nc nd 2 0
3 | cc-by-nc-sa | cc | cc by nc sa
3 | cc-by-nc-nd | cc | cc by nc nd
3 | cc-by-nc | cc | cc by nc
3 | cc-by-nd | cc | cc by nd
3 | cc-by-sa | cc | cc by sa
3 | cc-by | cc | cc by
2 | cc-by-4.0 | commons | creative commons attribution (?:4 0|4)(?: international)?(?: licen[cs]e)?
2 | cc-by-3.0 | commons | creative commons attribution (?:3 0|3)(?: unported)?(?: licen[cs]e)?
2 | cc-by-sa-4.0 | commons | creative commons attribution share ?alike (?:4 0|4)(?: international)?(?: licen[cs]e)?
2 | cc-by-sa-3.0 | commons | creative commons attribution share ?alike (?:3 0|3)(?: unported)?(?: licen[cs]e)?
2 | cc-by-nc-4.0 | commons | creative commons attribution non ?commercial (?:4 0|4)(?: international)?(?: licen[cs]e)?
2 | cc-by-nc-3.0 | commons | creative commons attribution non ?commercial (?:3 0|3)(?: unported)?(?: licen[cs]e)?
2 | cc-by-nd-4.0 | commons | creative commons attribution no ?derivatives (?:4 0|4)(?: international)?(?: licen[cs]e)?
2 | cc-by-nc-sa-4.0 | commons | creative commons attribution non ?commercial share ?alike (?:4 0|4)(?: international)?(?: licen[cs]e)?
2 | cc-by-nc-nd-4.0 | commons | creative commons attribution non ?commercial no ?derivatives (?:4 0|4)(?: international)?(?: licen[cs]e)?
3 | cc-by-nc-sa | commons | creative commons attribution non ?commercial share ?alike
3 | cc-by-nc-nd | commons | creative commons attribution non ?commercial no ?deriv(?:ative)?s
3 | cc-by-nc | commons | creative commons attribution non ?commercial
3 | cc-by-sa | commons | creative commons attribution share ?alike
3 | cc-by-nd | commons | creative commons attribution no ?deriv(?:ative)?s
3 | cc-by | commons | creative commons attribution
2 | cc-by-4.0 | licen | creativecommons org licenses by 4 0
2 | cc-by-3.0 | licen | creativecommons org licenses by 3 0
2 | cc-by-sa-4.0 | licen | creativecommons org licenses by sa 4 0
2 | cc-by-sa-3.0 | licen | creativecommons org licenses by sa 3 0
2 | cc-by-nc-4.0 | licen | creativecommons org licenses by nc 4 0
2 | cc-by-nd-4.0 | licen | creativecommons org licenses by nd 4 0
2 | cc-by-nc-sa-4.0 | licen | creativecommons org licenses by nc sa 4 0
2 | cc-by-nc-nd-4.0 | licen | creativecommons org licenses by nc nd 4 0
2 | cc-pdm-1.0 | domain | creative commons public domain mark(?: 1 0)?
4 | cc-unspecified | commons | (?:under a )?creative commons(?: licen[cs]e)?
1 | unlicense | domain | this is free and unencumbered software released into the public domain
1 | unlicense | spdx | spdx license identifier unlicense
3 | unlicense | unlicense | (?:the )?unlicense
1 | wtfpl | wtfpl | wtfpl(?: version 2)?
1 | wtfpl | licen | do what the fuck you want to public license
1 | zlib | permission | permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely
1 | zlib | spdx | spdx license identifier zlib
2 | zlib | licen | zlib (?:libpng )?licen[cs]e
2 | libpng | licen | (?:libpng|png reference library) licen[cs]e
1 | bsl-1.0 | licen | distributed under the boost software license version 1 0
1 | bsl-1.0 | spdx | spdx license identifier bsl 1 0
2 | bsl-1.0 | licen | boost software license(?: version)? 1 0
3 | boost | licen | boost software licen[cs]e
2 | busl-1.1 | licen | business source license (?:version )?1 1
3 | busl | licen | business source licen[cs]e
3 | sspl | licen | server side public licen[cs]e
2 | elastic-2.0 | licen | elastic license (?:version |v )?2(?: 0)?
3 | elastic | licen | elastic licen[cs]e
1 | artistic-2.0 | spdx | spdx license identifier artistic 2 0
1 | artistic-1.0 | spdx | spdx license identifier artistic 1 0
2 | artistic-2.0 | licen | artistic license (?:version |v )?2(?: 0)?
2 | artistic-1.0 | licen | artistic license (?:version |v )?1(?: 0)?
3 | artistic | licen | artistic licen[cs]e
2 | perl | licen | licensed under the same terms as perl(?: itself)?
2 | psf-2.0 | licen | (?:python software foundation|psf) license (?:version |v )?2
3 | psf | licen | (?:python software foundation|psf) licen[cs]e
3 | python | licen | python licen[cs]e
3 | ruby | licen | ruby(?: s)? licen[cs]e
2 | php-3.01 | licen | php license (?:version |v )?3 01
2 | php-3.0 | licen | php license (?:version |v )?3(?: 0)?
3 | php | licen | php licen[cs]e
2 | zend-2.0 | licen | zend (?:engine )?license (?:version |v )?2(?: 00| 0)?
3 | tcl | licen | tcl tk licen[cs]e
3 | openssl | licen | openssl licen[cs]e
3 | ssleay | licen | (?:original )?ssleay licen[cs]e
3 | curl | licen | curl licen[cs]e
3 | icu | licen | icu licen[cs]e
3 | unicode | licen | unicode(?: data files and software| inc)? licen[cs]e
3 | postgresql | licen | postgresql licen[cs]e
3 | vim | licen | vim licen[cs]e
3 | json | licen | json licen[cs]e
1 | json | evil | the software shall be used for good not evil
3 | ms-pl | licen | microsoft public licen[cs]e
3 | ms-rl | licen | microsoft reciprocal licen[cs]e
2 | osl-3.0 | licen | open software license (?:version |v )?3(?: 0)?
3 | osl | licen | open software licen[cs]e
2 | afl-3.0 | licen | academic free license (?:version |v )?3(?: 0)?
2 | afl-2.1 | licen | academic free license (?:version |v )?2 1
3 | afl | licen | academic free licen[cs]e
3 | ecl-2.0 | licen | educational community license(?: version)?(?: 2 0)?
3 | ncsa | licen | (?:university of illinois )?ncsa(?: open source)? licen[cs]e
2 | eupl-1.2 | licen | european union public licen[cs]e (?:version |v )?1 2
2 | eupl-1.1 | licen | european union public licen[cs]e (?:version |v )?1 1
3 | eupl | licen | european union public licen[cs]e
2 | cecill-2.1 | licen | cecill(?: free software)? license(?: agreement)? (?:version |v )?2 1
3 | cecill | licen | cecill(?: b| c)? licen[cs]e
1 | ofl-1.1 | licen | this font software is licensed under the sil open font license version 1 1
2 | ofl-1.1 | licen | (?:sil )?open font license (?:version |v )?1 1
2 | ofl-1.0 | licen | (?:sil )?open font license (?:version |v )?1 0
3 | ofl | licen | (?:sil )?open font licen[cs]e
3 | ubuntu-font | licen | ubuntu font licen[cs]e
3 | lppl | licen | latex project public licen[cs]e
2 | lppl-1.3c | licen | latex project public license (?:version |v )?1 3c
3 | qpl | licen | q public licen[cs]e
3 | sleepycat | licen | sleepycat (?:public )?licen[cs]e
3 | intel | licen | intel open source licen[cs]e
3 | nokia | licen | nokia open source licen[cs]e
3 | upl-1.0 | licen | universal permissive licen[cs]e
3 | mulan-psl | licen | mulan (?:permissive software|psl) licen[cs]e
1 | beerware | beer | (?:the )?beer ?ware license|if we meet some day and you think this stuff is worth it you can buy me a beer in return
3 | blueoak-1.0 | licen | blue oak model licen[cs]e
3 | hippocratic | licen | hippocratic licen[cs]e
3 | polyform-nc | licen | polyform noncommercial licen[cs]e
2 | odbl-1.0 | licen | open data(?:base| commons open database) license (?:version |v )?1 0
3 | odbl | licen | open database licen[cs]e
3 | odc-by | licen | open data commons attribution licen[cs]e
3 | pddl | domain | public domain dedication and licen[cs]e
2 | ogl-uk-3.0 | licen | open government licen[cs]e (?:version |v )?3(?: 0)?
2 | ogl-uk-2.0 | licen | open government licen[cs]e (?:version |v )?2(?: 0)?
3 | ogl-uk | licen | open government licen[cs]e
3 | etalab | licen | (?:etalab )?licence ouverte
3 | dl-de-by | datenlizenz | datenlizenz deutschland(?: namensnennung)?(?: version)?(?: 2 0)?
2 | openrail-m | licen | openrail m licen[cs]e
3 | openrail | licen | (?:bigscience |creativeml )?open ?rail licen[cs]e
3 | llama-community | licen | llama 2 community licen[cs]e
3 | proprietary | licen | (?:commercial|proprietary) licen[cs]e
3 | proprietary | rights | unpublished rights reserved under the copyright laws
3 | shareware | licen | shareware licen[cs]e
3 | eula | licen | end user licen[cs]e agreement
3 | public-domain | domain | (?:is |are |been )?(?:placed in|released in(?:to)?|dedicated to|in) the public domain
3 | public-domain | domain | public domain dedication
4 | public-domain | domain | public domain
4 | copyleft | copyleft | copyleft
4 | all-rights-reserved | rights | all rights reserved
4 | all-rights-reserved | vorbehalten | alle rechte vorbehalten
4 | all-rights-reserved | droits | tous droits r[eé]serv[eé]s
4 | all-rights-reserved | derechos | todos los derechos reservados
4 | some-rights-reserved | rights | some rights reserved
4 | no-rights-reserved | rights | no rights reserved
4 | copyright-notice | copyright | copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})*
4 | copyright-notice | copyright | copyright c
4 | warranty-disclaimer | warrant | (?:provided|distributed) (?:on an )?as is (?:basis )?without (?:any )?(?:express or implied )?warrant(?:y|ies)(?: of any kind)?
4 | warranty-disclaimer | warrant | without warrant(?:y|ies) (?:or conditions )?of any kind
4 | permission-notice | permission | permission is (?:hereby )?granted
4 | permission-notice | permission | (?:reprinted|reproduced|used) (?:with|by) permission
4 | license-reference | licen | see (?:the )?licen[cs]e(?: file| txt| md)?(?: for (?:details|more information))?
4 | license-reference | licen | (?:this work is |is |are )?(?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the |a |an )?[a-z0-9]{1,24} licen[cs]e
4 | license-reference | licen | this (?:work|file|software|program|document) is licensed under
4 | spdx-unknown | spdx | spdx license identifier [a-z0-9]{1,30}
"""


class Rule(NamedTuple):
    number: int
    priority: int
    label: str
    keyword: str
    expression: str
    base: bool


def spaced(expression: str) -> str:
    """The expression over words that each have a space of their own on either side."""
    return f" (?:{re.sub(' [?]?', lambda m: '(?:  )?' if len(m[0]) > 1 else '  ', expression)}) "


def _parsed(text: str, first: int, base: bool) -> list[Rule]:
    found = []
    for n, line in enumerate(text.strip().splitlines(), first):
        priority, label, keyword, expression = (x.strip() for x in line.split(" | ", 3))
        found.append(Rule(n, int(priority), label, keyword, spaced(expression), base))
    return found


_FIRST = _parsed(_BASE_RULES, 0, True)
RULES = _FIRST + _parsed(_RULES, len(_FIRST), False)
KEYWORDS = sorted({r.keyword for r in RULES})
