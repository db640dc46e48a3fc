"""Signatures of licenses, by section in order of priority.

A line is a label, blanks, and a regular expression over lower-cased text, in which a blank stands for whatever separates words.
No word character stands before or after a match."""

from __future__ import annotations

#: (priority, confidence, rules)
SECTIONS = [
    # machine-readable tags
    (100, 1.0, r"""
mit                 spdx license identifier:? mit
mit-0               spdx license identifier:? mit 0
0bsd                spdx license identifier:? 0bsd
bsd-1-clause        spdx license identifier:? bsd 1 clause
bsd-2-clause        spdx license identifier:? bsd 2 clause
bsd-3-clause        spdx license identifier:? bsd 3 clause
bsd-4-clause        spdx license identifier:? bsd 4 clause
isc                 spdx license identifier:? isc
zlib                spdx license identifier:? zlib
libpng              spdx license identifier:? libpng(?: 2 0)?
apache-1.1          spdx license identifier:? apache 1 1
apache-2            spdx license identifier:? apache 2 0
mpl-1.1             spdx license identifier:? mpl 1 1
mpl-2.0             spdx license identifier:? mpl 2 0
epl-1.0             spdx license identifier:? epl 1 0
epl-2.0             spdx license identifier:? epl 2 0
cddl-1.0            spdx license identifier:? cddl 1 0
cddl-1.1            spdx license identifier:? cddl 1 1
cpl-1.0             spdx license identifier:? cpl 1 0
gpl-1.0             spdx license identifier:? gpl 1 0(?: (?:only|or later)|\+)?
gpl-2.0             spdx license identifier:? gpl 2 0(?: (?:only|or later)|\+)?
gpl-3.0             spdx license identifier:? gpl 3 0(?: (?:only|or later)|\+)?
lgpl-2.0            spdx license identifier:? lgpl 2 0(?: (?:only|or later)|\+)?
lgpl-2.1            spdx license identifier:? lgpl 2 1(?: (?:only|or later)|\+)?
lgpl-3.0            spdx license identifier:? lgpl 3 0(?: (?:only|or later)|\+)?
agpl-3.0            spdx license identifier:? agpl 3 0(?: (?:only|or later)|\+)?
gfdl-1.2            spdx license identifier:? gfdl 1 2(?: (?:only|or later))?
gfdl-1.3            spdx license identifier:? gfdl 1 3(?: (?:only|or later))?
artistic-2.0        spdx license identifier:? artistic 2 0
artistic-1.0        spdx license identifier:? artistic 1 0(?: perl)?
bsl-1.0             spdx license identifier:? bsl 1 0
busl-1.1            spdx license identifier:? busl 1 1
sspl-1.0            spdx license identifier:? sspl 1 0
elastic-2.0         spdx license identifier:? elastic 2 0
eupl-1.1            spdx license identifier:? eupl 1 1
eupl-1.2            spdx license identifier:? eupl 1 2
unlicense           spdx license identifier:? unlicense
wtfpl               spdx license identifier:? wtfpl
ofl-1.1             spdx license identifier:? ofl 1 1
postgresql          spdx license identifier:? postgresql
python-2.0          spdx license identifier:? (?:python 2 0|psf 2 0)
ncsa                spdx license identifier:? ncsa
upl-1.0             spdx license identifier:? upl 1 0
afl-3.0             spdx license identifier:? afl 3 0
osl-3.0             spdx license identifier:? osl 3 0
zpl-2.1             spdx license identifier:? zpl 2 1
ms-pl               spdx license identifier:? ms pl
ms-rl               spdx license identifier:? ms rl
x11                 spdx license identifier:? x11
w3c                 spdx license identifier:? w3c
blueoak-1.0         spdx license identifier:? blueoak 1 0 0
mulanpsl-2.0        spdx license identifier:? mulanpsl 2 0
cecill-2.1          spdx license identifier:? cecill 2 1
odbl-1.0            spdx license identifier:? odbl 1 0
odc-by-1.0          spdx license identifier:? odc by 1 0
pddl-1.0            spdx license identifier:? pddl 1 0
ogl-3.0             spdx license identifier:? ogl uk 3 0
cc0-1.0             spdx license identifier:? cc0 1 0
cc-by-3.0           spdx license identifier:? cc by 3 0
cc-by-4.0           spdx license identifier:? cc by 4 0
cc-by-sa-3.0        spdx license identifier:? cc by sa 3 0
cc-by-sa-4.0        spdx license identifier:? cc by sa 4 0
cc-by-nc-4.0        spdx license identifier:? cc by nc 4 0
cc-by-nd-4.0        spdx license identifier:? cc by nd 4 0
cc-by-nc-sa-4.0     spdx license identifier:? cc by nc sa 4 0
cc-by-nc-nd-4.0     spdx license identifier:? cc by nc nd 4 0
"""),
    # sentences of the licenses' own texts
    (90, 1.0, r"""
mit                 permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit                 the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit                 to use copy modify merge publish distribute sublicense and or sell copies of the software
mit-0               permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided
isc                 permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice
0bsd                permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted the software is provided
bsd                 redistribution and use in source and binary forms with or without modification are permitted
bsd-2-clause        redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd-2-clause        redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
bsd-3-clause        neither the name of (?:[a-z0-9]+ ){1,9}nor the names of (?:its|the|other) contributors may be used to endorse or promote products
bsd-3-clause        the names? of (?:the|its) (?:author|authors|contributors|copyright holders?) may not be used to endorse or promote products
bsd-4-clause        all advertising materials mentioning features or use of this software must display the following acknowledge?ment
zlib                this software is provided as is without any express or implied warranty in no event will the authors be held liable
zlib                the origin of this software must not be misrepresented you must not claim that you wrote the original software
libpng              this source code may not be misrepresented as being the original source
apache-2            unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-2            you may not use this file except in compliance with the license you may obtain a copy of the license at
apache-2            each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license
apache-1.1          this product includes software developed by the apache software foundation
gpl-3.0             the gnu general public license is a free copyleft license for software and other kinds of works
gpl-2.0             activities other than copying distribution and modification are not covered by this license they are outside its scope
gpl                 this program is distributed in the hope that it will be useful but without any warranty
gpl                 the licenses for most software are designed to take away your freedom to share and change it
lgpl-3.0            this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license
lgpl-2.1            this is the first released version of the lesser gpl
lgpl                this library is distributed in the hope that it will be useful but without any warranty
agpl-3.0            the gnu affero general public license is a free copyleft license for software and other kinds of works specifically designed to ensure cooperation with the community in the case of network server software
agpl-3.0            remote network interaction use with the gnu general public license
gfdl                permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
mpl-2.0             this source code form is subject to the terms of the mozilla public license v(?:ersion)? ?2 0
mpl-2.0             if a copy of the mpl was not distributed with this file you can obtain one at
mpl-1.1             the contents of this file are subject to the mozilla public license version 1 1
epl-2.0             this program and the accompanying materials are made available under the terms of the eclipse public license v(?:ersion)? ?2 0
epl-1.0             this program and the accompanying materials are made available under the terms of the eclipse public license v(?:ersion)? ?1 0
cpl-1.0             the accompanying program is provided under the terms of this common public license
cddl-1.0            the contents of this file are subject to the terms of the common development and distribution license
artistic-2.0        this license establishes the terms under which a given free software package may be copied modified distributed
artistic-1.0        the intent of this document is to state the conditions under which a package may be copied
bsl-1.0             permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
unlicense           this is free and unencumbered software released into the public domain
unlicense           anyone is free to copy modify publish use compile sell or distribute this software
wtfpl               everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed
wtfpl               you just do what the fuck you want to
gpl                 everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed
ofl-1.1             this font software is licensed under the sil open font license version 1 1
ofl-1.1             the goals of the open font license ofl are to stimulate worldwide development of collaborative font projects
postgresql          permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
python-2.0          this license agreement is between the python software foundation psf and the individual or organization
openssl             this product includes software developed by the openssl project for use in the openssl toolkit
ncsa                redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimers
upl-1.0             subject to the condition set forth below permission is hereby granted to any person obtaining a copy of this software associated documentation and or data
ms-pl               if you use the software you accept this license if you do not accept the license do not use the software
ms-rl               for any file you distribute that contains code from the software in source code or binary format you must provide recipients the source code to that file along with a copy of this license
w3c                 permission to copy modify and distribute this work with or without modification for any purpose and without fee or royalty is hereby granted
x11                 except as contained in this notice the name of the x consortium shall not be used in advertising
vim                 there are no restrictions on distributing unmodified copies of vim
eupl-1.2            the work is provided under the terms of this european union public licence
busl-1.1            the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work
sspl-1.0            if you make the functionality of the program or a modified version available to third parties as a service you must make the service source code available
elastic-2.0         you may not provide the software to third parties as a hosted or managed service
blueoak-1.0         this license gives everyone as much permission to work with this software as possible while protecting contributors from liability
mulanpsl-2.0        you can use this software according to the terms and conditions of the mulan psl v2
odbl-1.0            this database is made available under the open database licen[sc]e
pddl-1.0            this database is made available under the public domain dedication and licen[sc]e
odc-by-1.0          this database is made available under the open data commons attribution licen[sc]e
ogl-3.0             contains public sector information licensed under the open government licence(?: v3 0)?
cc0-1.0             the person who associated a work with this deed has dedicated the work to the public domain
cc-by               you must give appropriate credit provide a link to the license and indicate if changes were made
cc-by-sa            if you remix transform or build upon the material you must distribute your contributions under the same license as the original
cc-by-nd            if you remix transform or build upon the material you may not distribute the modified material
cc-by-nc            you may not use the material for commercial purposes
"""),
    # headers and grants
    (80, 1.0, r"""
apache-2            licensed under the apache license,? version 2(?: 0)?
apache-2            licensed to the apache software foundation asf under one or more contributor license agreements
mit                 (?:is |are )?(?:licensed|released|distributed|published|available|provided) under the(?: terms of the)? mit licen[sc]e
bsd                 (?:licensed|released|distributed|published|available) under (?:the|a)(?: terms of the)? bsd licen[sc]e
bsd                 use of this source code is governed by a bsd style license
mit                 use of this source code is governed by an mit style license
gpl-3.0             under the terms of the gnu general public license as published by the free software foundation either version 3
gpl-2.0             under the terms of the gnu general public license as published by the free software foundation either version 2
gpl-2.0             under the terms of the gnu general public license version 2 as published by the free software foundation
gpl-3.0             under the terms of the gnu general public license version 3 as published by the free software foundation
lgpl-2.1            under the terms of the gnu (?:lesser|library) general public license as published by the free software foundation either version 2(?: 1)?
lgpl-3.0            under the terms of the gnu lesser general public license as published by the free software foundation either version 3
agpl-3.0            under the terms of the gnu affero general public license as published by the free software foundation either version 3
gfdl-1.2            under the terms of the gnu free documentation license version 1 2
gfdl-1.3            under the terms of the gnu free documentation license version 1 3
perl                this (?:program|library|module) is free software you can redistribute it and or modify it under the same terms as perl itself
ruby                you may redistribute this software under the same terms as ruby
php-3.01            this source file is subject to version 3 01 of the php license
zpl-2.1             this software is subject to the provisions of the zope public license version 2 1
bsl-1.0             distributed under the boost software license(?: version 1 0)?
vim                 (?:licensed|released|distributed) under (?:the )?vim license
ofl-1.1             (?:licensed|released|available) under the(?: sil)? open font license
isc                 (?:licensed|released|distributed|available) under the isc license
zlib                (?:licensed|released|distributed|available) under(?: the)? zlib(?: license)?
unlicense           (?:licensed|released|distributed|available) under the unlicense
wtfpl               (?:licensed|released|distributed|available) under the wtfpl
mpl-2.0             (?:licensed|released|distributed|available) under(?: the)? (?:mpl|mozilla public licen[sc]e) (?:version |v)?2(?: 0)?
gpl-2.0             (?:licensed|released|distributed|available) under(?: the)? (?:gnu )?(?:gpl|general public licen[sc]e) (?:version |v)?2(?: 0)?
gpl-3.0             (?:licensed|released|distributed|available) under(?: the)? (?:gnu )?(?:gpl|general public licen[sc]e) (?:version |v)?3(?: 0)?
"""),
    # creative commons, by name and address
    (70, 0.95, r"""
cc-by-nc-sa-4.0     (?:cc|creative commons) (?:by nc sa|attribution non ?commercial share ?alike) (?:v|version )?4(?: 0)?
cc-by-nc-sa-3.0     (?:cc|creative commons) (?:by nc sa|attribution non ?commercial share ?alike) (?:v|version )?3(?: 0)?
cc-by-nc-sa-2.5     (?:cc|creative commons) (?:by nc sa|attribution non ?commercial share ?alike) (?:v|version )?2 5
cc-by-nc-sa-2.0     (?:cc|creative commons) (?:by nc sa|attribution non ?commercial share ?alike) (?:v|version )?2(?: 0)?
cc-by-nc-nd-4.0     (?:cc|creative commons) (?:by nc nd|attribution non ?commercial no ?deriv(?:ative)?s) (?:v|version )?4(?: 0)?
cc-by-nc-nd-3.0     (?:cc|creative commons) (?:by nc nd|attribution non ?commercial no ?deriv(?:ative)?s) (?:v|version )?3(?: 0)?
cc-by-nc-nd-2.5     (?:cc|creative commons) (?:by nc nd|attribution non ?commercial no ?deriv(?:ative)?s) (?:v|version )?2 5
cc-by-nc-nd-2.0     (?:cc|creative commons) (?:by nc nd|attribution non ?commercial no ?deriv(?:ative)?s) (?:v|version )?2(?: 0)?
cc-by-nc-4.0        (?:cc|creative commons) (?:by nc|attribution non ?commercial) (?:v|version )?4(?: 0)?
cc-by-nc-3.0        (?:cc|creative commons) (?:by nc|attribution non ?commercial) (?:v|version )?3(?: 0)?
cc-by-nc-2.5        (?:cc|creative commons) (?:by nc|attribution non ?commercial) (?:v|version )?2 5
cc-by-nc-2.0        (?:cc|creative commons) (?:by nc|attribution non ?commercial) (?:v|version )?2(?: 0)?
cc-by-sa-4.0        (?:cc|creative commons) (?:by sa|attribution share ?alike) (?:v|version )?4(?: 0)?
cc-by-sa-3.0        (?:cc|creative commons) (?:by sa|attribution share ?alike) (?:v|version )?3(?: 0)?
cc-by-sa-2.5        (?:cc|creative commons) (?:by sa|attribution share ?alike) (?:v|version )?2 5
cc-by-sa-2.0        (?:cc|creative commons) (?:by sa|attribution share ?alike) (?:v|version )?2(?: 0)?
cc-by-nd-4.0        (?:cc|creative commons) (?:by nd|attribution no ?deriv(?:ative)?s) (?:v|version )?4(?: 0)?
cc-by-nd-3.0        (?:cc|creative commons) (?:by nd|attribution no ?deriv(?:ative)?s) (?:v|version )?3(?: 0)?
cc-by-nd-2.0        (?:cc|creative commons) (?:by nd|attribution no ?deriv(?:ative)?s) (?:v|version )?2(?: 0)?
cc-by-4.0           (?:cc|creative commons) (?:by|attribution) (?:v|version )?4(?: 0)?
cc-by-3.0           (?:cc|creative commons) (?:by|attribution) (?:v|version )?3(?: 0)?
cc-by-2.5           (?:cc|creative commons) (?:by|attribution) (?:v|version )?2 5
cc-by-2.0           (?:cc|creative commons) (?:by|attribution) (?:v|version )?2(?: 0)?
cc0-1.0             (?:cc0|creative commons zero)(?: v?1 0)?
cc-by-nc-sa-4.0     creativecommons org licenses by nc sa 4 0
cc-by-nc-sa-3.0     creativecommons org licenses by nc sa 3 0
cc-by-nc-nd-4.0     creativecommons org licenses by nc nd 4 0
cc-by-nc-nd-3.0     creativecommons org licenses by nc nd 3 0
cc-by-nc-4.0        creativecommons org licenses by nc 4 0
cc-by-nc-3.0        creativecommons org licenses by nc 3 0
cc-by-sa-4.0        creativecommons org licenses by sa 4 0
cc-by-sa-3.0        creativecommons org licenses by sa 3 0
cc-by-nd-4.0        creativecommons org licenses by nd 4 0
cc-by-4.0           creativecommons org licenses by 4 0
cc-by-3.0           creativecommons org licenses by 3 0
cc0-1.0             creativecommons org publicdomain zero 1 0
public-domain       creativecommons org publicdomain mark 1 0
cc-by-nc-sa         (?:cc by nc sa|creative commons attribution non ?commercial share ?alike)
cc-by-nc-nd         (?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s)
cc-by-nc            (?:cc by nc|creative commons attribution non ?commercial)
cc-by-sa            (?:cc by sa|creative commons attribution share ?alike)
cc-by-nd            (?:cc by nd|creative commons attribution no ?deriv(?:ative)?s)
cc-by               (?:cc by|creative commons attribution)
creative-commons    licensed under a creative commons licen[sc]e
"""),
    # addresses of license texts
    (65, 0.95, r"""
apache-2            apache org licenses license 2 0
apache-2            opensource org licenses apache 2 0
mit                 opensource org licenses mit(?: license)?
bsd-3-clause        opensource org licenses bsd 3 clause
bsd-2-clause        opensource org licenses bsd 2 clause
gpl-3.0             gnu org licenses gpl 3 0
gpl-2.0             gnu org licenses (?:old licenses )?gpl 2 0
lgpl-3.0            gnu org licenses lgpl 3 0
lgpl-2.1            gnu org licenses (?:old licenses )?lgpl 2 1
agpl-3.0            gnu org licenses agpl 3 0
gfdl-1.3            gnu org licenses fdl 1 3
gpl                 gnu org licenses gpl
mpl-2.0             mozilla org mpl 2 0
mpl-1.1             mozilla org mpl mpl 1 1
epl-2.0             eclipse org legal epl (?:v20|2 0)
epl-1.0             eclipse org legal epl v10
bsl-1.0             boost org license 1 0
unlicense           unlicense org
ofl-1.1             scripts sil org ofl
wtfpl               wtfpl net
odbl-1.0            opendatacommons org licenses odbl
ogl-3.0             nationalarchives gov uk doc open government licence version 3
"""),
    # names with their versions
    (60, 0.9, r"""
agpl-3.0            (?:gnu )?(?:agpl|affero general public licen[sc]e) (?:version |v)?3(?: 0)?
lgpl-2.1            (?:gnu )?(?:lgpl|lesser general public licen[sc]e|library general public licen[sc]e) (?:version |v)?2 1
lgpl-2.0            (?:gnu )?(?:lgpl|lesser general public licen[sc]e|library general public licen[sc]e) (?:version |v)?2(?: 0)?
lgpl-3.0            (?:gnu )?(?:lgpl|lesser general public licen[sc]e) (?:version |v)?3(?: 0)?
gpl-1.0             (?:gnu )?(?:gpl|general public licen[sc]e) (?:version |v)?1(?: 0)?
gpl-2.0             (?:gnu )?(?:gpl|general public licen[sc]e) (?:version |v)?2(?: 0)?
gpl-3.0             (?:gnu )?(?:gpl|general public licen[sc]e) (?:version |v)?3(?: 0)?
gpl-2.0             gplv2
gpl-3.0             gplv3
lgpl-2.1            lgplv2 1
lgpl-3.0            lgplv3
agpl-3.0            agplv3
gfdl-1.2            (?:gnu )?(?:gfdl|free documentation licen[sc]e) (?:version |v)?1 2
gfdl-1.3            (?:gnu )?(?:gfdl|free documentation licen[sc]e) (?:version |v)?1 3
apache-1.0          apache(?: software)? licen[sc]e (?:version |v)?1 0
apache-1.1          apache(?: software)? licen[sc]e (?:version |v)?1 1
apache-2            apache(?: software)?(?: licen[sc]e)? (?:version |v)?2(?: 0)?
mpl-1.1             (?:mpl|mozilla public licen[sc]e) (?:version |v)?1 1
mpl-2.0             (?:mpl|mozilla public licen[sc]e) (?:version |v)?2(?: 0)?
epl-1.0             (?:epl|eclipse public licen[sc]e) (?:version |v)?1(?: 0)?
epl-2.0             (?:epl|eclipse public licen[sc]e) (?:version |v)?2(?: 0)?
cddl-1.0            (?:cddl|common development and distribution licen[sc]e) (?:version |v)?1 0
cddl-1.1            (?:cddl|common development and distribution licen[sc]e) (?:version |v)?1 1
cpl-1.0             common public licen[sc]e (?:version |v)?1 0
artistic-2.0        artistic licen[sc]e (?:version |v)?2(?: 0)?
artistic-1.0        artistic licen[sc]e (?:version |v)?1(?: 0)?
eupl-1.1            (?:eupl|european union public licen[sc]e) (?:version |v)?1 1
eupl-1.2            (?:eupl|european union public licen[sc]e) (?:version |v)?1 2
osl-3.0             (?:osl|open software licen[sc]e) (?:version |v)?3(?: 0)?
afl-3.0             (?:afl|academic free licen[sc]e) (?:version |v)?3(?: 0)?
zpl-2.1             (?:zpl|zope public licen[sc]e) (?:version |v)?2 1
bsl-1.0             boost software licen[sc]e (?:version |v)?1 0
busl-1.1            business source licen[sc]e(?: (?:version |v)?1 1)?
sspl-1.0            server side public licen[sc]e(?: (?:version |v)?1)?
elastic-2.0         elastic licen[sc]e(?: (?:version |v)?2 0)?
upl-1.0             universal permissive licen[sc]e(?: (?:version |v)?1 0)?
cecill-2.1          cecill (?:version |v)?2 1
lppl-1.3c           (?:lppl|latex project public licen[sc]e) (?:version |v)?1 3c?
mulanpsl-2.0        mulan (?:psl|permissive software licen[sc]e) (?:version |v)?2
ogl-3.0             open government licen[sc]e (?:version |v)?3(?: 0)?
ogl-2.0             open government licen[sc]e (?:version |v)?2(?: 0)?
bsd-4-clause        (?:4 clause|four clause|original) bsd|bsd 4 clause
bsd-3-clause        (?:3 clause|three clause|new|modified|revised) bsd|bsd 3 clause
bsd-2-clause        (?:2 clause|two clause|simplified|freebsd) bsd|bsd 2 clause
0bsd                (?:zero clause bsd|bsd zero clause|0bsd)
mit-0               mit no attribution
"""),
    # names alone
    (40, 0.8, r"""
mit                 (?:mit|expat) licen[sc]e
mit                 see the mit (?:licen[sc]e|terms)
mit                 licen[sc]e: mit
bsd                 bsd(?: style)? licen[sc]e
bsd                 licen[sc]e: bsd
isc                 isc licen[sc]e
isc                 licen[sc]e: isc
zlib                (?:zlib|zlib libpng) licen[sc]e
apache              apache licen[sc]e
apache              licen[sc]e: apache
x11                 x11 licen[sc]e
agpl                (?:agpl|gnu affero general public licen[sc]e|affero gpl)
lgpl                (?:lgpl|gnu (?:lesser|library) general public licen[sc]e|lesser gpl)
gpl                 (?:gpl|gnu general public licen[sc]e|gnu public licen[sc]e)
gfdl                (?:gfdl|gnu free documentation licen[sc]e)
mpl                 mozilla public licen[sc]e
epl                 eclipse public licen[sc]e
cddl-1.0            common development and distribution licen[sc]e
artistic-1.0        artistic licen[sc]e
bsl-1.0             boost software licen[sc]e
eupl-1.2            european union public licen[sc]e
osl-3.0             open software licen[sc]e
afl-3.0             academic free licen[sc]e
ofl-1.1             (?:sil )?open font licen[sc]e
odbl-1.0            (?:open database licen[sc]e|odbl)
odc-by-1.0          open data commons attribution(?: licen[sc]e)?
pddl-1.0            (?:open data commons )?public domain dedication and licen[sc]e
ogl-3.0             open government licen[sc]e
postgresql          postgresql licen[sc]e
python-2.0          (?:python software foundation|psf) licen[sc]e
openssl             openssl licen[sc]e
ms-pl               (?:microsoft public licen[sc]e|ms pl)
ms-rl               (?:microsoft reciprocal licen[sc]e|ms rl)
ncsa                (?:university of illinois ncsa open source licen[sc]e|ncsa licen[sc]e)
zpl-2.1             zope public licen[sc]e
cecill-2.1          cecill licen[sc]e
lppl-1.3c           latex project public licen[sc]e
ruby                ruby licen[sc]e
php-3.01            php licen[sc]e
vim                 vim licen[sc]e
w3c                 w3c (?:software )?(?:notice and )?licen[sc]e
wtfpl               (?:wtfpl|do what the fuck you want to public licen[sc]e)
unlicense           the unlicense
beerware            beer ?ware licen[sc]e
jsonlicense         the software shall be used for good not evil
llama               llama (?:2|3|3 1|3 2) community licen[sc]e
openrail            (?:creativeml )?open ?rail(?: m)?(?: licen[sc]e)?
"""),
    # no licence granted, or none needed
    (20, 0.6, r"""
public-domain       (?:dedicated to|released (?:in ?to|to)|placed in(?: ?to)?|in) the public domain
public-domain       no copyright is claimed
public-domain       this work is free of known copyright restrictions
proprietary         all rights reserved
proprietary         this (?:software|document|material) is (?:the )?(?:confidential and proprietary|proprietary and confidential)
proprietary         unauthori[sz]ed (?:copying|reproduction|distribution|use) of this (?:file|software|document|material)
proprietary         may not be (?:copied|reproduced|distributed|used) without (?:the )?(?:prior |express )?(?:written )?permission
proprietary         strictly confidential
proprietary         for internal use only
non-commercial      for (?:personal and )?non ?commercial (?:use|purposes)(?: only)?
non-commercial      not for commercial use
evaluation          for evaluation purposes only
shareware           this (?:program|software) is shareware
freeware            this (?:program|software) is freeware
permission          reproduced (?:here )?(?:with|by) (?:kind )?permission
"""),
]
