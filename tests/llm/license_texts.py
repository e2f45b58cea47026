"""Texts as they stand in files: (labels that a scan finds, text). Each signature written by hand matches one of them."""

TEXTS = (
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal
 * in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
 * copies of the Software. The above copyright notice and this permission notice (including the next paragraph) shall be included in all copies or substantial portions of the Software.
 * THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""),
    ("mit", "Released under the terms of the MIT"), ("mit", "licensed under the Expat"), ("mit", "distributed under the X11"),
    ("ncsa", "University of Illinois/NCSA Open Source License. Permission is granted ... to deal with the Software without restriction, including without limitation the rights to use"),
    ("0bsd", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES'),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("isc", "THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."),
    ("hpnd", "Permission to use, copy, modify, distribute, and sell this software and its documentation for any purpose is hereby granted without fee, and that the name of X not be used in advertising or publicity pertaining to distribution of the software"),
    ("x11", "shall not be used in advertising or otherwise to promote the sale, use or other dealings in this Software without prior written authorization from the X Consortium"),
    ("mit-cmu", "Permission to use, copy, modify and distribute this software and its documentation for any purpose and without fee is hereby granted"),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that: 1. Redistributions of source code must retain the above copyright notice, this list
of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES"""),
    ("bsd-3-clause", "Neither the name of the Example University nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("bsd-3-clause", "3. The name of the author may not be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the Example Company."),
    ("bsd-2-clause-views", "The views and conclusions contained in the software and documentation are those of the authors"),
    ("bsd-3-clause-clear", "NO EXPRESS OR IMPLIED LICENSES TO ANY PARTY'S PATENT RIGHTS ARE GRANTED BY THIS LICENSE."),
    ("bsd-3-clause-no-nuclear", "this software is not designed, licensed or intended for use in the design, construction, operation or maintenance of any nuclear facility"),
    ("bsd-2-clause-patent", "each copyright holder and contributor hereby grants to those receiving rights under this license a perpetual, worldwide license"),
    ("postgresql", "for any purpose, without fee, and without a written agreement is hereby granted. IN NO EVENT SHALL THE UNIVERSITY OF CALIFORNIA BE LIABLE TO ANY PARTY FOR DIRECT, INDIRECT, SPECIAL, INCIDENTAL, OR CONSEQUENTIAL DAMAGES"),
    ("w3c", "Permission to copy, modify, and distribute this work, with or without modification, for any purpose and without fee or royalty is hereby granted"),
    ("w3c", "This software or document includes material copied from or derived from [title and URI of the W3C document]."),
    ("unicode", "UNICODE, INC. LICENSE AGREEMENT - DATA FILES AND SOFTWARE. Any person obtaining a copy of the Unicode data files and any associated documentation"),
    ("libpng", 'The PNG Reference Library is supplied "AS IS".'), ("libtiff", "the names of Sam Leffler and Silicon Graphics may not be used"),
    ("ijg", "This software is based in part on the work of the Independent JPEG Group."), ("ftl", "Portions of this software are copyright (C) 2006 The FreeType Project"),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable. 1. The origin of this software must not be misrepresented; you must not
claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such"""),
    ("info-zip", "This is version 2005-Feb-10 of the Info-ZIP copyright and license."), ("openssl", "This product includes cryptographic software written by Eric Young (eay)"),
    ("openssl", 'The names "OpenSSL Toolkit" and "OpenSSL Project" must not be used to endorse or promote products'), ("openssl", "This product includes software developed by the OpenSSL Project"),
    ("ssleay", "This package is an SSL implementation written by Eric Young"),
    ("apache-1.1", 'This product includes software developed by the Apache Software Foundation. Products derived from this software may not be called "Apache"'),
    ("apache-2", """Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. The ASF licenses this file to you; it is licensed under the Apache License.
# You may not use this file except in compliance with the License. You may obtain a copy of the License at
#     http://www.apache.org/licenses/LICENSE-2.0
# Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS.
# See the License for the specific language governing permissions and limitations under the License."""),
    ("apache", "each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable patent license"),
    ("apache-2", "If You institute patent litigation against any entity (including a cross-claim or counterclaim in a lawsuit)"), ("apache-2", 'If the Work includes a "NOTICE" text file as part of its distribution'),
    ("apache-2", "any Contribution intentionally submitted for inclusion in the Work by You"), ("upl", "any piece of software and/or hardware listed in the lrgrwrks.txt file"),
    ("ecl", "Licensed under the Educational Community License, Version 2.0"), ("mulanpsl", "You can use this software according to the terms and conditions of the Mulan PSL v2."),
    ("blueoak", "Blue Oak Model License. Each contributor licenses you to do everything with this software that would otherwise infringe that contributor's copyright"),
    ("vim", "There are no restrictions on distributing unmodified copies of Vim"), ("python", "This LICENSE AGREEMENT is between the Python Software Foundation"),
    ("python", "BEOPEN PYTHON OPEN SOURCE LICENSE AGREEMENT"), ("python", 'This LICENSE AGREEMENT is between the Corporation for National Research Initiatives, having an office at Reston ("CNRI")'),
    ("python", "PSF hereby grants Licensee a nonexclusive, royalty-free, world-wide license"), ("tcl", "The authors hereby grant permission to use, copy, modify, distribute, and license this software and its documentation for any purpose"),
    ("sleepycat", "Redistributions in any form must be accompanied by information on how to obtain complete source code"), ("php", 'The name "PHP" must not be used to endorse or promote products derived from this software'),
    ("php", "This product includes PHP software, freely available from http://www.php.net"), ("zend", "This product includes the Zend Engine, freely available at http://www.zend.com"),
    ("fair", "Usage of the works is permitted provided that this instrument is retained with the works"),
    ("bsl", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation ... must be included in all copies of the Software, in whole or in part, and all derivative works of the Software"),
    ("bsl", "Distributed under the Boost Software License"), ("beerware", "As long as you retain this notice you can do whatever you want with this stuff. If we meet some day, and you think this stuff is worth it, you can buy me a beer in return"),
    ("wtfpl", "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed. 0. You just DO WHAT THE FUCK YOU WANT TO. http://www.wtfpl.net/"),
    ("blessing", "May you find forgiveness for yourself and forgive others."), ("fsfap", "Copying and distribution of this file, with or without modification, are permitted in any medium without royalty"),
    ("fsful", "the Free Software Foundation gives unlimited permission to copy and/or distribute it"), ("fsfullr", "gives unlimited permission to copy and/or distribute it, with or without modifications, as long as this notice is preserved."),
    ("verbatim-copies", "Permission is granted to make and distribute verbatim copies of this manual provided the copyright notice is preserved"),
    ("json", "The Software shall be used for Good, not Evil."), ("ruby", "Ruby is copyrighted free software by Yukihiro Matsumoto"), ("ruby", "You can redistribute it and/or modify it under either the terms of the 2-clause BSDL"),
    ("curl", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("ipl", "The accompanying program is provided under the terms of this IBM Public License"), ("cpl", "The accompanying program is provided under the terms of this Common Public License"),
    ("epl", "The accompanying program is provided under the terms of this Eclipse Public License"), ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0"),
    ("epl-2", "This Source Code may also be made available under the following Secondary Licenses"), ("epl", "http://www.eclipse.org/legal/epl-v10.html"),
    ("mpl", "The contents of this file are subject to the Mozilla Public License. See the License for the specific language governing rights and limitations under the License."),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("mpl-no-copyleft-exception", 'This Source Code Form is "Incompatible With Secondary Licenses", as defined by the Mozilla Public License'), ("npl", "The contents of this file are subject to the Netscape Public License"),
    ("cddl", "The contents of this file are subject to the terms of the Common Development and Distribution License. usr/src/OPENSOLARIS.LICENSE or http://www.opensolaris.org/os/licensing. When distributing Covered Code, include this CDDL HEADER in each file"),
    ("apsl", "Modifications of Original Code as defined in and that are subject to the Apple Public Source License"), ("spl", "The contents of this file are subject to the Sun Public License"), ("nasa", "NASA OPEN SOURCE AGREEMENT VERSION 1.3"),
    ("cpal", "Common Public Attribution License"), ("rpl", "Reciprocal Public License"), ("qpl", "the Q Public License"), ("afl", "Licensed under the Academic Free License version 3.0"), ("osl", "Licensed under the Open Software License version 3.0"),
    ("artistic", "The intent of this document is to state the conditions under which a Package may be copied"), ("artistic", "under the same terms as Perl itself"), ("artistic", "You may distribute under the terms of the Artistic License"),
    ("artistic-2", "This license establishes the terms under which a given free software Package may be copied, modified, distributed"), ("cecill", "This software is governed by the CeCILL-B license under French law"),
    ("cecill", "Ce logiciel est régi par la licence CeCILL"), ("eupl", "Licensed under the EUPL, Version 1.2 or - as soon they will be approved by the European Commission"),
    ("lppl", "This work may be distributed and/or modified under the conditions of the LaTeX Project Public License. This work has the LPPL maintenance status `maintained'."),
    ("ms-pl", "This license governs use of the accompanying software. If you use the software, you accept this license."), ("ms-rl", "If you distribute any portion of the software in source code form, you may do so only under this license"),
    ("gpl", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.
 This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
 You should have received a copy of the GNU General Public License along with this program; if not, write to the Free Software Foundation, Inc., 51 Franklin Street"""),
    ("gpl", "If not, see <https://www.gnu.org/licenses/>."), ("gnu-license-text", "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."),
    ("gpl", "The licenses for most software and other practical works are designed to take away your freedom to share and change"), ("gpl-2", "under the terms of version 2 of the GNU General Public License"),
    ("gpl-3", "under the terms of version 3 of the GNU General Public License"), ("gpl-2", "License: GPLv2 only"), ("gpl-3", "License: GPLv3 or later"),
    ("gpl", "This is free software: you are free to change and redistribute it. There is NO WARRANTY, to the extent permitted by law."), ("gpl", "Gnomovision comes with ABSOLUTELY NO WARRANTY"), ("gpl", 'MODULE_LICENSE("GPL");'),
    ("gpl", "https://www.gnu.org/copyleft/gpl.html"), ("lgpl", "https://www.gnu.org/licenses/lgpl.html"), ("agpl", "https://www.gnu.org/licenses/agpl.html"),
    ("lgpl", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY.
 You should have received a copy of the GNU Lesser General Public License along with this library"""),
    ("lgpl-3", "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License"),
    ("lgpl", "A program that contains no derivative of any portion of the Library, but is designed to work with the Library"),
    ("agpl", "under the terms of the GNU Affero General Public License. You should have received a copy of the GNU Affero General Public License along with this program."),
    ("agpl", "your modified version must prominently offer all users interacting with it remotely through a computer network"), ("agpl", "specifically designed to ensure cooperation with the community in the case of network server software"),
    ("gfdl", 'Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License; with no Invariant Sections, no Front-Cover Texts, and no Back-Cover Texts. A copy of the license is included in the section entitled "GNU Free Documentation License".'),
    ("llvm-exception", "As an exception, if, as a result of your compiling your source code, portions of this Software are embedded into an Object form"), ("llvm-exception", "Part of the LLVM Project, under the Apache License v2.0 with LLVM Exceptions."),
    ("classpath-exception", "give you permission to link this library with independent modules to produce an executable"), ("classpath-exception", 'Oracle designates this particular file as subject to the "Classpath" exception'),
    ("autoconf-exception", "if you distribute this file as part of a program that contains a configuration script generated by Autoconf"), ("libtool-exception", "if you distribute this file as part of a program or library that is built using GNU Libtool"),
    ("bison-exception", "you may create a larger work that contains part or all of the Bison parser skeleton"), ("gcc-exception", "additional permissions described in the GCC Runtime Library Exception, version 3.1"),
    ("font-exception", "As a special exception, if you create a document which uses this font, and embed this font"), ("macros-exception", "As a special exception, if other files instantiate templates or use macros or inline functions from this file"),
    ("openssl-exception", "permission to link the code of portions of this program with the OpenSSL library"), ("linux-syscall-note", "This copyright does *not* cover user programs that use kernel services by normal system calls"),
    ("qt-lgpl-exception", "the object code form of a \"work that uses the Library\" may incorporate material from a header file"), ("foss-exception", "MySQL FLOSS License Exception"),
    ("dual", "Licensed under either of Apache License, Version 2.0 or MIT license at your option."), ("dual", "Alternatively, this software may be distributed under the terms of the GNU General Public License"), ("dual", "This is dual-licensed under MIT"),
    ("dual", 'subject to the terms of either the GNU General Public License Version 2 only ("GPL") or the Common Development and Distribution License'), ("dual", "available under either the Foo terms or the Bar public licence"),
    ("dual", "You may choose either license."), ("dual", "multi-licensed under"), ("sspl", "Server Side Public License. If you make the functionality of the Program or a modified version available to third parties as a service"),
    ("busl", "Business Source License: copy, modify, create derivative works, redistribute, and make non-production use of the Licensed Work. Effective on the Change Date, or the fourth anniversary of the first publicly available distribution"),
    ("elastic", "the Elastic License 2.0: You may not provide the software to third parties as a hosted or managed service"), ("commons-clause", '"Commons Clause" License Condition v1.0: the License does not grant to you, the right to Sell the Software'),
    ("polyform", "PolyForm Noncommercial License 1.0.0. Any noncommercial purpose is a permitted purpose."), ("confluent", "Confluent Community License"), ("rsal", "Redis Source Available License"), ("prosperity", "The Prosperity Public License"),
    ("parity", "The Parity Public License"), ("hippocratic", "Hippocratic License 3.0"), ("anti-996", "Anti-996 License"), ("openrail", "CreativeML Open RAIL-M; Use-based restrictions as referenced in paragraph 5"), ("llama", "LLAMA 2 COMMUNITY LICENSE AGREEMENT"),
    ("gemma", "Gemma Terms of Use"), ("cc0", "The person who associated a work with this deed has dedicated the work to the public domain by waiving all rights"), ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights"),
    ("cc", "This work is licensed under a Creative Commons licence. To view a copy of this license, visit http://creativecommons.org/licenses"), ("cc-by", "Except where otherwise noted, content on this site is licensed under a Creative Commons Attribution 4.0 license"),
    ("cc-by", "creativecommons.org/licenses/by/4.0/"), ("cc-by-sa", "creativecommons.org/licenses/by-sa/3.0/"), ("cc-by-nc", "creativecommons.org/licenses/by-nc/4.0/"), ("cc-by-nd", "creativecommons.org/licenses/by-nd/4.0/"),
    ("cc-by-nc-sa", "creativecommons.org/licenses/by-nc-sa/4.0/"), ("cc-by-nc-nd", "creativecommons.org/licenses/by-nc-nd/4.0/"), ("cc0", "creativecommons.org/publicdomain/zero/1.0/"), ("public-domain", "creativecommons.org/publicdomain/mark/1.0/"),
    ("cc-by", "You must give appropriate credit, provide a link to the license, and indicate if changes were made."), ("cc-by-sa", "If you remix, transform, or build upon the material, you must distribute your contributions under the same license"),
    ("cc-by-nc", "You may not use the material for commercial purposes."), ("cc-by-nd", "If you remix, transform, or build upon the material, you may not distribute the modified material."),
    ("ofl", "This Font Software is licensed under the SIL Open Font License. The OFL allows the licensed fonts to be used, studied, modified and redistributed freely. No Modified Version of the Font Software may use the Reserved Font Name(s)"),
    ("ofl", "No Modified Version of the Font Software may use the Reserved Font Name unless permitted"), ("ofl", "with Reserved Font Name X, http://scripts.sil.org/OFL"), ("bitstream-vera", "obtaining a copy of the fonts accompanying this license"), ("ubuntu-font", "UBUNTU FONT LICENCE"), ("gust-font", "GUST Font License"),
    ("odbl,dbcl", "This MyMap is made available under the Open Database License. Any rights in individual contents of the database are licensed under the Database Contents License"), ("odc-by", "Open Data Commons Attribution License"),
    ("pddl", "Open Data Commons Public Domain Dedication and Licence"), ("cdla", "Community Data License Agreement - Permissive - Version 2.0"), ("ogl-uk", "Contains public sector information licensed under the Open Government Licence v3.0."),
    ("etalab", "Licence Ouverte / Open Licence"), ("dl-de", "Datenlizenz Deutschland – Namensnennung"), ("opl", "Open Publication License"), ("fal", "Licence Art Libre"), ("ogl-1.0a", "OPEN GAME LICENSE Version 1.0a"),
    ("mit", "http://www.opensource.org/licenses/mit-license.php"), ("bsd", "https://opensource.org/licenses/BSD-3-Clause"), ("bsl-1", "http://www.boost.org/LICENSE_1_0.txt"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software. For more information, please refer to <https://unlicense.org>"),
    ("public-domain", "This file is hereby placed into the public domain."), ("public-domain", "The author disclaims copyright and gives it to the public domain"),
    ("all-rights-reserved,copyright", "Copyright (c) 2019 Example. All rights reserved."), ("proprietary", "PROPRIETARY AND CONFIDENTIAL. Unauthorized copying of this file is prohibited."),
    ("proprietary", 'This software is the confidential and proprietary information of Example Inc.'), ("proprietary", "contains valuable trade secrets of Example"), ("proprietary", "protected by copyright laws and international copyright treaties"),
    ("proprietary", "may not be disclosed to any third party without consent"), ("proprietary", "You may not reverse engineer, decompile, or disassemble"), ("proprietary", "The Software is licensed, not sold."),
    ("proprietary", "Unauthorized reproduction or distribution of this program"), ("proprietary", "For internal use only"), ("eula", "subject to the terms of the End-User License Agreement"), ("eula", "MICROSOFT SOFTWARE LICENSE TERMS"),
    ("no-redistribution", "No part of this publication may be reproduced"), ("no-redistribution", "may not be copied, reproduced or redistributed without prior written permission"), ("restricted-rights", "Use, duplication, or disclosure by the U.S. Government is subject to restrictions"),
    ("research-only", "for academic research purposes only"), ("education-only", "for educational use only"), ("personal-use", "Free for personal use"), ("commercial", "for personal and non-commercial use only"), ("evaluation", "For evaluation purposes only"),
    ("us-government-work", "It is a work of the U.S. Government and is not subject to copyright protection"), ("public-domain", "No copyright is claimed"), ("dco", "Developer Certificate of Origin. By making a contribution to this project, I certify that"),
    ("copyright", "SPDX-FileCopyrightText: 2022 Jane"), ("trademark", "Foo is a registered trademark of Bar"), ("trademark", "These are trademarks of their owners"), ("patent", "Protected by one or more U.S. patents"),
    ("license-file", "See the accompanying LICENSE file for details"), ("license-file", "found in the LICENSE file in the root directory of this source tree."),
)
