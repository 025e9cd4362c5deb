"""Wording of licence texts, file notices and licence names, for the rules of
operator 3. Fixed values, written as the scanner sees a text: lower case, words
joined by single blanks; parts may be regular expressions.

``SENTENCES`` are whole sentences of a licence or of the notice that goes into
files, ``NAMES`` what stands before "license". The keyword of a rule is its longest
plain word.
"""

SENTENCES = {
    "mit": """
the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
the rights to use copy modify merge publish distribute sublicense and or sell copies of the software
in no event shall the authors or copyright holders be liable for any claim damages or other liability
arising from out of or in connection with the software or the use or other dealings in the software
the software is provided as is without warranty of any kind express or implied
""",
    "isc": """
provided that the above copyright notice and this permission notice appear in all copies
the author disclaims all warranties with regard to this software including all implied warranties
whether in an action of contract negligence or other tortious action
""",
    "bsd": """
redistributions of source code must retain the above copyright notice
redistributions in binary form must reproduce the above copyright notice
this software is provided by the (?:copyright holders|regents|authors?)(?: and contributors)? as is and any express or implied warranties
procurement of substitute goods or services loss of use data or profits
use of this source code is governed by a bsd style licen[cs]e
""",
    "bsd-0-clause": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "bsd-2-clause": """
the views and conclusions contained in the software and documentation are those of the authors
""",
    "bsd-3-clause": """
neither the names? of (?:[^ ]+ ){1,12}may be used to endorse or promote products derived from this software
""",
    "bsd-4-clause": "all advertising materials mentioning features or use of this software must display the following acknowledge?ment",
    "bsd-3-clause-clear": """
subject to the limitations in the disclaimer below
no express or implied licenses to any party s patent rights are granted by this license
""",
    "gpl": """
you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e
distributed in the hope that it will be useful but without any warranty
without even the implied warranty of merchantability or fitness for a particular purpose
you should have received a copy of the gnu general public licen[cs]e
everyone is permitted to copy and distribute verbatim copies of this license document
is intended to guarantee your freedom to share and change
parts of it might be released under the gpl and only under the gpl
""",
    "gpl-2.0": """
the licenses for most software are designed to take away your freedom
terms and conditions for copying distribution and modification
you may not copy modify sublicense or distribute the program except as expressly provided under this license
""",
    "gpl-3.0": """
the gnu general public license is a free copyleft license for software and other kinds of works
you may convey verbatim copies of the program s source code as you receive it
no covered work shall be deemed part of an effective technological measure
""",
    "lgpl": """
you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[cs]e
you should have received a copy of the gnu (?:lesser|library) general public licen[cs]e
a program that contains no derivative of any portion of the library
""",
    "lgpl-3.0": "incorporates the terms and conditions of version 3 of the gnu general public licen[cs]e",
    "agpl": """
you can redistribute it and or modify it under the terms of the gnu affero general public licen[cs]e
you should have received a copy of the gnu affero general public licen[cs]e
""",
    "agpl-3.0": """
the gnu affero general public license is a free copyleft license
must prominently offer all users interacting with it remotely
""",
    "gpl-linking-exception": """
as a special exception the copyright holders of this (?:library|program) give you permission to link
classpath exception
gcc runtime library exception
permission to link the code of portions of this program with the openssl library
as a special exception you may create a larger work that contains part or all of the bison parser
as a special exception if you create a document which uses this font
this exception does not however invalidate any other reasons why the executable file might be covered
""",
    "gfdl": """
permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e
with no invariant sections no front cover texts and no back cover texts
the purpose of this license is to make a manual textbook or other functional and useful document free
""",
    "fsf-all-permissive": "with or without modification are permitted in any medium without royalty",
    "apache-2.0": """
you may not use this file except in compliance with the licen[cs]e
software distributed under the license is distributed on an as is basis without warranties or conditions of any kind
see the license for the specific language governing permissions and limitations under the license
subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide
any contribution intentionally submitted for inclusion in the work by you
""",
    "apache": """
see the notice file distributed with this work for additional information regarding copyright ownership
this product includes software developed (?:by|at) the apache software foundation
the names apache and apache software foundation must not be used to endorse
""",
    "apache-1.1": "the end user documentation included with the redistribution if any must include the following",
    "mpl": """
the contents of this file are subject to the mozilla public licen[cs]e
the initial developer of the original code is
see the license for the specific language governing rights and limitations
""",
    "mpl-2.0": """
this source code form is subject to the terms of the mozilla public licen[cs]e
if a copy of the mpl was not distributed with this file
this source code form is incompatible with secondary licenses
""",
    "epl": """
made available under the terms of the eclipse public licen[cs]e
the accompanying program is provided under the terms of this eclipse public licen[cs]e
any use reproduction or distribution of the program constitutes recipient s acceptance of this agreement
""",
    "cpl": "the accompanying program is provided under the terms of this common public licen[cs]e",
    "cddl": """
subject to the terms of the common development and distribution licen[cs]e
when distributing covered code include this cddl header notice in each file
""",
    "bsl-1.0": """
distributed under the boost software licen[cs]e
to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
machine executable object code generated by a source language processor
""",
    "zlib": """
in no event will the authors be held liable for any damages arising from the use of this software
the origin of this software must not be misrepresented
altered source versions must be plainly marked as such
this notice may not be removed or altered from any source distribution
""",
    "unlicense": """
anyone is free to copy modify publish use compile sell or distribute this software
we make this dedication for the benefit of the public at large
overt act of relinquishment in perpetuity
""",
    "wtfpl": """
do what the fuck you want to(?: public licen[cs]e)?
""",
    "cc0-1.0": """
the person who associated a work with this deed has dedicated the work to the public domain
waived all copyright and related or neighboring rights
the laws of most jurisdictions throughout the world automatically confer exclusive copyright
""",
    "cc": """
this work is licensed under a creative commons
to view a copy of this licen[cs]e visit (?:https? )?(?:www )?creativecommons org
the work as defined below is provided under the terms of this creative commons public licen[cs]e
by exercising the licensed rights defined below you accept and agree to be bound by
available under the creative commons attribution share ?alike licen[cs]e
creative commons legal code
""",
    "beerware": """
you can buy me a beer in return
the beer ?ware licen[cs]e
""",
    "json": "the software shall be used for good not evil",
    "artistic": """
the intent of this document is to state the conditions under which a package may be copied
you may charge a reasonable copying fee for any distribution of this package
under the same terms as perl itself
the copyright holder maintains some semblance of artistic control
""",
    "psf": """
this license agreement is between the python software foundation
psf hereby grants licensee a nonexclusive royalty free world ?wide license
beopen python open source licen[cs]e agreement
cnri (?:open source gpl compatible )?licen[cs]e agreement
""",
    "openssl": """
this product includes software developed by the openssl project
this product includes cryptographic software written by eric young
products derived from this software may not be called openssl
""",
    "php": "this product includes php software freely available from",
    "ofl": """
this font software is licensed under the sil open font licen[cs]e
to stimulate worldwide development of collaborative font projects
no modified version of the font software may use the reserved font name
""",
    "bitstream-vera": "no copy of one or more of the font software typefaces may be sold by itself",
    "ncsa": """
to deal with the software without restriction
university of illinois(?: ncsa)? open source licen[cs]e
""",
    "postgresql": "for any purpose without fee and without a written agreement is hereby granted",
    "hpnd": """
both that copyright notice and this permission notice appear in supporting documentation
without specific written prior permission
makes no representations about the suitability of this software for any purpose
""",
    "x11": "the name of the x consortium shall not be used in advertising",
    "unicode": """
obtaining a copy of the unicode data files
unicode inc licen[cs]e agreement data files and software
""",
    "w3c": """
w3c software (?:and document )?(?:notice and )?licen[cs]e
by obtaining using and or copying this work you the licensee agree
""",
    "odbl": "this database is made available under the open database licen[cs]e",
    "odc-by": "open data commons attribution licen[cs]e",
    "pddl": "public domain dedication and licen[cs]e",
    "dbcl": "any rights in individual contents of the database are licensed under the database contents licen[cs]e",
    "ogl-uk": "contains public sector information licensed under the open government licen[cs]e",
    "busl": """
the licensor hereby grants you the right to copy modify create derivative works redistribute and make non ?production use
additional use grant
""",
    "elastic": "you may not provide the software to third parties as a hosted or managed service",
    "sspl": "make the functionality of the program or a modified version available to third parties as a service",
    "commons-clause": """
commons clause licen[cs]e condition
the license does not grant to you the right to sell the software
""",
    "openrail": """
creativeml open ?rail(?: m)?
bigscience (?:open )?rail(?: m)?
open responsible ai licen[cs]es?
""",
    "ms-pl": "if you use the software you accept this license if you do not accept the license do not use the software",
    "ijg": "this software is based in part on the work of the independent jpeg group",
    "lppl": """
distributed and or modified under the conditions of the latex project public licen[cs]e
this work has the lppl maintenance status
""",
    "mit-or-apache-2.0": """
licensed under either of apache licen[cs]e version 2 0 or mit licen[cs]e
dual licensed under (?:the )?(?:mit and apache|apache and mit)
""",
    "mit-or-gpl": "dual licensed under (?:the )?(?:mit and gpl|gpl and mit|mit or gpl)",
    "us-government-work": """
work of the (?:united states|u s) government
not subject to copyright protection in the united states
""",
    "proprietary": """
confidential and proprietary information of
you shall not disclose such confidential information
no part of this (?:publication|document|book) may be reproduced
stored in a retrieval system or transmitted in any form
end user licen[cs]e agreement
reverse engineer decompile or disassemble
may not be reproduced distributed or transmitted without (?:the )?(?:prior )?(?:express )?written permission
contains (?:valuable )?trade secrets
""",
}

NAMES = {
    "apple-public-source": "apple public source", "ibm-public": "ibm public", "lucent-public": "lucent public",
    "nokia-open-source": "nokia open source", "sun-public": "sun public", "open-watcom": "sybase open watcom public",
    "intel-open-source": "intel open source", "netscape-public": "netscape public", "qpl": "q public",
    "ricoh-public": "ricoh source code public", "reciprocal-public": "reciprocal public",
    "realnetworks-public": "realnetworks public source", "cpal": "common public attribution",
    "cecill": "cecill(?: [abc])?(?: free software)?", "mulan-psl": "mulan permissive software", "eiffel-forum": "eiffel forum",
    "entessa": "entessa public", "fair": "the fair", "frameworx": "frameworx open", "motosoto": "motosoto open source",
    "naumen": "naumen public", "nethack": "nethack general public", "oclc": "oclc research public",
    "open-group": "open group test suite", "vovida": "vovida software", "wxwindows": "wxwindows library",
    "xnet": "x net", "zend": "zend(?: engine)?", "sleepycat": "sleepycat", "ruby": "ruby", "tcl": "tcl(?: tk)?", "vim": "vim",
    "info-zip": "info zip", "libpng": "libpng", "libtiff": "libtiff", "imagemagick": "imagemagick",
    "freetype": "freetype(?: project)?", "lppl": "latex project public", "openldap": "openldap public", "jython": "jython",
    "hippocratic": "hippocratic", "anti-996": "anti 996", "parity": "parity public", "prosperity": "prosperity public",
    "blue-oak": "blue oak model", "upl": "universal permissive", "cern-ohl": "cern open hardware",
    "tapr-ohl": "tapr open hardware", "solderpad": "solderpad hardware", "free-art": "free art", "design-science": "design science",
    "open-publication": "open publication", "open-content": "open content", "ogl-uk": "open government", "icu": "icu",
    "curl": "curl", "ntp": "ntp", "polyform": "polyform (?:non ?commercial|small business|shield|strict|perimeter|internal use)",
    "mit-0": "mit no attribution", "expat": "expat", "eclipse-distribution": "eclipse distribution", "netcdf": "netcdf",
    "mpich": "mpich", "json": "json", "unicode": "unicode", "ms-limited-public": "microsoft limited public",
    "postgresql": "postgresql", "openssl": "openssl", "llama-community": r"llama(?: \d)?(?: \d)? community", "bittorrent": "bittorrent open source",
    "bitstream-vera": "bitstream vera", "sissl": "sun industry standards source", "ecl": "educational community",
    "nasa-osa": "nasa open source", "ipa-font": "ipa font", "rail": "responsible ai", "yahoo-public": "yahoo public",
}
