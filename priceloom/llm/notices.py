"""Signatures of notices, exceptions, dual statements and addresses of licenses, written by hand."""

from __future__ import annotations

#: Sentences as (label, word that each match holds, pattern over words with single spaces).
NOTICES = (
    # permissive notices
    ("mit", "deal", r"to deal in the software without restriction including without limitation the rights"),
    ("ncsa", "deal", r"to deal with the software without restriction including without limitation the rights"),
    ("ncsa", "ncsa", r"university of illinois ncsa open source license"),
    ("0bsd", "fee", r"for any purpose with or without fee is hereby granted the software is provided as is"),
    ("isc", "fee", r"for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("hpnd", "sell", r"permission to use copy modify distribute and sell this software and its documentation for any purpose is hereby granted without fee"),
    ("hpnd", "publicity", r"not be used in advertising or publicity pertaining to distribution of the software"),
    ("x11", "dealings", r"shall not be used in advertising or otherwise to promote the sale use or other dealings in this software without prior written authorization"),
    ("mit-cmu", "documentation", r"permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted"),
    ("bsd", "warranties", r"this software is provided by the (?:\S+ ){1,8}as is and any express or implied warranties"),
    ("bsd-2-clause-views", "conclusions", r"the views and conclusions contained in the software and documentation are those of the authors"),
    ("bsd-3-clause", "endorse", r"the name of the author may not be used to endorse or promote products derived from this software"),
    ("bsd-3-clause-clear", "patent", r"no express or implied licenses to any party s patent rights are granted by this license"),
    ("bsd-3-clause-no-nuclear", "nuclear", r"not designed licensed or intended for use in the design construction operation or maintenance of any nuclear facility"),
    ("bsd-2-clause-patent", "contributor", r"each copyright holder and contributor hereby grants to those receiving rights under this license a perpetual"),
    ("postgresql", "california", r"in no event shall the university of california be liable to any party for direct indirect special incidental or consequential damages"),
    ("postgresql", "agreement", r"without fee and without a written agreement is hereby granted"),
    ("w3c", "royalty", r"permission to copy modify and distribute this work with or without modification for any purpose and without fee or royalty is hereby granted"),
    ("w3c", "material", r"this software or document includes material copied from or derived from"),
    ("unicode", "unicode", r"unicode inc license agreement data files and software"),
    ("unicode", "unicode", r"obtaining a copy of the unicode data files and any associated documentation"),
    ("libpng", "png", r"the png reference library is supplied as is"),
    ("libtiff", "leffler", r"the names of sam leffler and silicon graphics may not be used"),
    ("ijg", "jpeg", r"this software is based in part on the work of the independent jpeg group"),
    ("ftl", "freetype", r"portions of this software are copyright (?:\S+ ){1,3}the freetype project"),
    ("zlib", "acknowledgment", r"if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not required"),
    ("info-zip", "zip", r"this is version (?:\S+ ){1,5}of the info zip (?:copyright and )?license"),
    ("openssl", "cryptographic", r"this product includes cryptographic software written by eric young"),
    ("openssl", "toolkit", r"the names openssl toolkit and openssl project must not be used to endorse or promote products"),
    ("ssleay", "ssl", r"this package is an ssl implementation written by eric young"),
    ("apache-1.1", "apache", r"this product includes software developed by the apache software foundation"),
    ("apache-1.1", "apache", r"products derived from this software may not be called apache"),
    ("apache-2", "writing", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-2", "permissions", r"see the license for the specific language governing permissions and limitations under the license"),
    ("apache-2", "asf", r"licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("apache-2", "litigation", r"if you institute patent litigation against any entity including a cross claim or counterclaim"),
    ("apache-2", "notice", r"if the work includes a notice text file as part of its distribution"),
    ("apache-2", "contribution", r"any contribution intentionally submitted for inclusion in the work by you"),
    ("upl", "lrgrwrks", r"any piece of software and or hardware listed in the lrgrwrks txt file"),
    ("ecl", "educational", r"licensed under the educational community license"),
    ("mulanpsl", "mulan", r"you can use this software according to the terms and conditions of the mulan psl"),
    ("blueoak", "infringe", r"each contributor licenses you to do everything with this software that would otherwise infringe"),
    ("blueoak", "oak", r"blue oak model license"),
    ("vim", "vim", r"there are no restrictions on distributing unmodified copies of vim"),
    ("python", "python", r"this license agreement is between the python software foundation"),
    ("python", "beopen", r"beopen python open source license agreement"),
    ("python", "cnri", r"this license agreement is between the corporation for national research initiatives (?:\S+ ){0,8}cnri"),
    ("tcl", "authors", r"the authors hereby grant permission to use copy modify distribute and license this software and its documentation for any purpose"),
    ("sleepycat", "accompanied", r"redistributions in any form must be accompanied by information on how to obtain complete source code"),
    ("php", "php", r"the name php must not be used to endorse or promote products derived from this software"),
    ("zend", "zend", r"this product includes the zend engine freely available at"),
    ("fair", "instrument", r"usage of the works is permitted provided that this instrument is retained with the works"),
    ("bsl", "derivative", r"must be included in all copies of the software in whole or in part and all derivative works of the software"),
    ("beerware", "stuff", r"as long as you retain this notice you can do whatever you want with this stuff"),
    ("wtfpl", "verbatim", r"permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed"),
    ("blessing", "forgiveness", r"may you find forgiveness for yourself and forgive others"),
    ("fsfap", "royalty", r"copying and distribution of this file with or without modification are permitted in any medium without royalty"),
    ("fsful", "unlimited", r"the free software foundation gives unlimited permission to copy and or distribute it"),
    ("fsfullr", "unlimited", r"unlimited permission to copy and or distribute it with or without modifications as long as this notice is preserved"),
    ("verbatim-copies", "verbatim", r"permission is granted to make and distribute verbatim copies of this manual provided the copyright notice"),
    # weak and strong copyleft
    ("ipl", "ibm", r"the accompanying program is provided under the terms of this ibm public license"),
    ("cpl", "common", r"the accompanying program is provided under the terms of this common public license"),
    ("epl", "eclipse", r"the accompanying program is provided under the terms of this eclipse public license"),
    ("epl-2", "secondary", r"this source code may also be made available under the following secondary licenses"),
    ("mpl", "mozilla", r"the contents of this file are subject to the mozilla public license"),
    ("mpl", "governing", r"see the license for the specific language governing rights and limitations under the license"),
    ("mpl-no-copyleft-exception", "incompatible", r"this source code form is incompatible with secondary licenses as defined by the mozilla public license"),
    ("npl", "netscape", r"the contents of this file are subject to the netscape public license"),
    ("cddl", "opensolaris", r"or http www opensolaris org os licensing"),
    ("cddl", "cddl", r"when distributing covered code include this cddl header in each file"),
    ("apsl", "apple", r"subject to the apple public source license"),
    ("spl", "sun", r"the contents of this file are subject to the sun public license"),
    ("nasa", "nasa", r"nasa open source agreement"),
    ("cpal", "attribution", r"common public attribution license"),
    ("rpl", "reciprocal", r"reciprocal public license"),
    ("qpl", "q", r"(?:the )?q public license"),
    ("afl", "academic", r"licensed under the academic free license"),
    ("osl", "open", r"licensed under the open software license"),
    ("artistic", "package", r"the intent of this document is to state the conditions under which a package may be copied"),
    ("artistic-2", "establishes", r"this license establishes the terms under which a given free software package may be copied modified distributed"),
    ("ruby", "either", r"you can redistribute it and or modify it under either the terms of the (?:2 clause bsdl|gpl)"),
    ("cecill", "cecill", r"this software is governed by the cecill (?:\S+ )?license under french law"),
    ("cecill", "licence", r"ce logiciel est régi par la licence cecill"),
    ("eupl", "commission", r"as soon (?:as )?they will be approved by the european commission"),
    ("lppl", "latex", r"this work may be distributed and or modified under the conditions of the latex project public license"),
    ("lppl", "maintenance", r"this work has the lppl maintenance status"),
    ("ms-rl", "portion", r"if you distribute any portion of the software in source code form you may do so only under this license"),
    ("gpl", "hope", r"this program is distributed in the hope that it will be useful but without any warranty"),
    ("gpl", "foundation", r"if not write to the free software foundation inc (?:59 temple place|51 franklin st(?:reet)?|675 mass ave)"),
    ("gpl", "gnu", r"if not see https? www gnu org licenses"),
    ("gnu-license-text", "changing", r"permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    ("gpl", "freedom", r"the licenses for most software (?:and other practical works )?are designed to take away your freedom to share and change"),
    ("gpl-2", "version", r"under the terms of version 2 of the gnu general public license"),
    ("gpl-3", "version", r"under the terms of version 3 of the gnu general public license"),
    ("gpl-2", "gplv2", r"gplv2(?: only| or later)?"),
    ("gpl-3", "gplv3", r"gplv3(?: only| or later)?"),
    ("gpl", "redistribute", r"this is free software you are free to change and redistribute it there is no warranty to the extent permitted by law"),
    ("gpl", "absolutely", r"comes with absolutely no warranty"),
    ("gpl", "module", r"module license gpl"),
    ("lgpl", "hope", r"this library is distributed in the hope that it will be useful but without any warranty"),
    ("lgpl-3", "incorporates", r"this version of the gnu lesser general public license incorporates the terms and conditions of version 3"),
    ("lgpl", "derivative", r"a program that contains no derivative of any portion of the library but is designed to work with the library"),
    ("agpl", "affero", r"under the terms of the gnu affero general public license"),
    ("agpl", "cooperation", r"specifically designed to ensure cooperation with the community in the case of network server software"),
    ("gfdl", "entitled", r"a copy of the license is included in the section entitled gnu free documentation license"),
    # exceptions
    ("llvm-exception", "compiling", r"as an exception if as a result of your compiling your source code portions of this software are embedded into an object form"),
    ("llvm-exception", "llvm", r"under the apache license v2 0 with llvm exceptions"),
    ("classpath-exception", "modules", r"permission to link this library with independent modules to produce an executable"),
    ("classpath-exception", "classpath", r"designates this particular file as subject to the classpath exception"),
    ("autoconf-exception", "autoconf", r"if you distribute this file as part of a program that contains a configuration script generated by autoconf"),
    ("libtool-exception", "libtool", r"if you distribute this file as part of a program or library that is built using gnu libtool"),
    ("bison-exception", "bison", r"you may create a larger work that contains part or all of the bison parser skeleton"),
    ("gcc-exception", "gcc", r"additional permissions described in the gcc runtime library exception"),
    ("font-exception", "font", r"as a special exception if you create a document which uses this font and embed this font"),
    ("macros-exception", "templates", r"as a special exception if other files instantiate templates or use macros or inline functions from this file"),
    ("openssl-exception", "openssl", r"permission to link the code of portions of this program with the openssl library"),
    ("linux-syscall-note", "kernel", r"does not cover user programs that use kernel services by normal system calls"),
    ("qt-lgpl-exception", "header", r"the object code form of a work that uses the library may incorporate material from a header file"),
    ("foss-exception", "exception", r"(?:universal )?f(?:l)?oss (?:license )?exception"),
    # dual and several licenses
    ("dual", "option", r"licensed under either of (?:\S+ ){1,40}?at your option"),
    ("dual", "alternatively", r"alternatively (?:this software|the contents of this file|this file) may be (?:used|distributed) under the terms of"),
    ("dual", "development", r"subject to the terms of either the gnu general public license version 2 only gpl or the common development and distribution license"),
    ("dual", "either", r"(?:available|released|distributed|licensed) under either the (?:\S+ ){1,8}or the (?:\S+ ){1,8}licen[cs]e"),
    ("dual", "choose", r"you may choose (?:which|either) licen[cs]e"),
    ("dual", "multi", r"multi licensed under"),
    # services, competition and use
    ("sspl", "functionality", r"if you make the functionality of the program or a modified version available to third parties as a service"),
    ("sspl", "side", r"server side public license"),
    ("busl", "production", r"copy modify create derivative works redistribute and make non production use of the licensed work"),
    ("busl", "anniversary", r"effective on the change date or the fourth anniversary of the first publicly available distribution"),
    ("busl", "business", r"business source license"),
    ("elastic", "hosted", r"you may not provide the software to third parties as a hosted or managed service"),
    ("elastic", "elastic", r"(?:licensed under )?the elastic license"),
    ("commons-clause", "commons", r"commons clause license condition"),
    ("commons-clause", "sell", r"the license does not grant to you the right to sell the software"),
    ("polyform", "polyform", r"polyform (?:noncommercial|small business|shield|perimeter|strict|free trial|internal use) license"),
    ("polyform", "permitted", r"any noncommercial purpose is a permitted purpose"),
    ("confluent", "confluent", r"confluent community license"),
    ("rsal", "redis", r"redis source available license"),
    ("prosperity", "prosperity", r"prosperity public license"),
    ("parity", "parity", r"parity public license"),
    ("hippocratic", "hippocratic", r"hippocratic license"),
    ("anti-996", "996", r"anti 996 license"),
    ("openrail", "rail", r"(?:creativeml open|bigscience(?: open)?|code open) rail(?: m)?(?: license)?"),
    ("openrail", "restrictions", r"use based restrictions as referenced in paragraph 5"),
    ("llama", "llama", r"llama \d(?: \d)? community license agreement"),
    ("gemma", "gemma", r"gemma terms of use"),
    # works, fonts and data
    ("cc0", "waiving", r"has dedicated the work to the public domain by waiving"),
    ("cc", "creativecommons", r"to view a copy of this license visit https? (?:www )?creativecommons org licenses"),
    ("cc-by", "otherwise", r"except where otherwise noted (?:\S+ ){1,8}(?:is|are) licensed under a creative commons attribution"),
    ("cc-by", "creativecommons", r"creativecommons org licenses by \d \d"),
    ("cc-by-sa", "creativecommons", r"creativecommons org licenses by sa \d \d"),
    ("cc-by-nc", "creativecommons", r"creativecommons org licenses by nc \d \d"),
    ("cc-by-nd", "creativecommons", r"creativecommons org licenses by nd \d \d"),
    ("cc-by-nc-sa", "creativecommons", r"creativecommons org licenses by nc sa \d \d"),
    ("cc-by-nc-nd", "creativecommons", r"creativecommons org licenses by nc nd \d \d"),
    ("cc0", "creativecommons", r"creativecommons org publicdomain zero 1 0"),
    ("public-domain", "creativecommons", r"creativecommons org publicdomain mark 1 0"),
    ("ofl", "fonts", r"the ofl allows the licensed fonts to be used studied modified and redistributed freely"),
    ("ofl", "font", r"with reserved font name"),
    ("bitstream-vera", "fonts", r"obtaining a copy of the fonts accompanying this license"),
    ("ubuntu-font", "ubuntu", r"ubuntu font licen[cs]e"),
    ("gust-font", "gust", r"gust font license"),
    ("odbl", "database", r"this (?:\S+ ){1,4}is made available under the open database license"),
    ("dbcl", "contents", r"any rights in individual contents of the database are licensed under the database contents license"),
    ("odc-by", "attribution", r"open data commons attribution license"),
    ("pddl", "dedication", r"open data commons public domain dedication and licen[cs]e"),
    ("cdla", "community", r"community data license agreement (?:permissive|sharing)"),
    ("ogl-uk", "sector", r"contains public sector information licensed under the open government licence"),
    ("etalab", "ouverte", r"licence ouverte"),
    ("dl-de", "datenlizenz", r"datenlizenz deutschland"),
    ("opl", "publication", r"open publication license"),
    ("fal", "art", r"(?:free art license|licence art libre)"),
    ("ogl-1.0a", "game", r"open game license version 1 0a"),
    # addresses
    ("mit", "opensource", r"opensource org licenses? mit(?: license)?"),
    ("bsd", "opensource", r"opensource org licenses? bsd(?: license| 3 clause| 2 clause)?"),
    ("apache-2", "apache", r"apache org licenses license 2 0"),
    ("gpl", "gnu", r"gnu org (?:licenses|copyleft) gpl"),
    ("lgpl", "gnu", r"gnu org (?:licenses|copyleft) lgpl"),
    ("agpl", "gnu", r"gnu org licenses agpl"),
    ("mpl-2", "mozilla", r"mozilla org mpl 2 0"),
    ("bsl-1", "boost", r"boost org license 1 0 txt"),
    ("epl", "eclipse", r"eclipse org legal epl"),
    ("unlicense", "unlicense", r"for more information please refer to https? unlicense org"),
    ("wtfpl", "wtfpl", r"www wtfpl net"),
    ("ofl", "sil", r"scripts sil org ofl"),
    # rights kept
    ("proprietary", "confidential", r"(?:is|contains) (?:the )?confidential and proprietary information of"),
    ("proprietary", "secrets", r"contains (?:valuable )?(?:confidential information and )?trade secrets of"),
    ("proprietary", "treaties", r"protected by copyright laws? and international (?:copyright )?treaties"),
    ("proprietary", "disclosed", r"may not be disclosed to (?:any )?third part(?:y|ies) without"),
    ("proprietary", "decompile", r"reverse engineer decompile or disassemble"),
    ("proprietary", "sold", r"(?:this software|the software) is licensed not sold"),
    ("proprietary", "reproduction", r"unauthorized reproduction or distribution of this (?:program|software)"),
    ("proprietary", "internal", r"for internal use only"),
    ("eula", "user", r"subject to the terms of (?:the|an|this) end user licen[cs]e agreement"),
    ("eula", "microsoft", r"microsoft software license terms"),
    ("no-redistribution", "reproduced", r"no part of this (?:publication|work|book|document|website) may be reproduced"),
    ("restricted-rights", "duplication", r"use duplication or disclosure by the (?:u s |us |united states )?government is subject to restrictions"),
    ("research-only", "research", r"for (?:academic |educational )?(?:and )?research (?:purposes|use) only"),
    ("education-only", "educational", r"for educational (?:purposes|use) only"),
    ("personal-use", "personal", r"free for personal use"),
    ("us-government-work", "government", r"is a work of the (?:u s|us|united states) government and is not subject to copyright protection"),
    ("public-domain", "claimed", r"no copyright is claimed"),
    ("dco", "certificate", r"developer certificate of origin"),
    ("dco", "certify", r"by making a contribution to this project i certify that"),
    ("copyright", "spdx", r"spdx filecopyrighttext"),
)
