"""Fixed texts of public licences: full texts, notices, titles and SPDX tags. (name, text) each; order decides ties."""

from __future__ import annotations

import pkgutil


def _full(name: str) -> str:
    return pkgutil.get_data(__package__, f"licenses/{name}.txt").decode()


_GRANT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
          "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
          "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
          "permit persons to whom the Software is furnished to do so")
_AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
          "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
          "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
          "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE "
          "SOFTWARE.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution.")
_ENDORSE = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
            "products derived from this software without specific prior written permission.")
_ADVERTISE = ("All advertising materials mentioning features or use of this software must display the following "
              "acknowledgement: This product includes software developed by")
_BSD_END = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
            "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
            "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
            "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
            "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
            "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY "
            "OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_ISC_END = ("THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
            "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
            "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
            "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
            "USE OR PERFORMANCE OF THIS SOFTWARE.")
_AFFERO = ("13. Remote Network Interaction; Use with the GNU General Public License. Notwithstanding any other provision of "
           "this License, if you modify the Program, your modified version must prominently offer all users interacting with "
           "it remotely through a computer network (if your version supports such interaction) an opportunity to receive the "
           "Corresponding Source of your version by providing access to the Corresponding Source from a network server at no "
           "charge, through some standard or customary means of facilitating copying of software.")

SHORT = [
    ("MIT", f"MIT License {_GRANT}, subject to the following conditions: The above copyright notice and this permission notice "
            f"shall be included in all copies or substantial portions of the Software. {_AS_IS}"),
    ("MIT-0", f"MIT No Attribution {_GRANT}. {_AS_IS}"),
    ("BSD-2-Clause", f"{_BSD} {_BSD_END}"),
    ("BSD-3-Clause", f"{_BSD} 3. {_ENDORSE} {_BSD_END}"),
    ("BSD-4-Clause", f"{_BSD} 3. {_ADVERTISE} the organization. 4. {_ENDORSE} {_BSD_END}"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            f"granted, provided that the above copyright notice and this permission notice appear in all copies. {_ISC_END}"),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             f"granted. {_ISC_END}"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
             "liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
             "software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject "
             "to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim "
             "that you wrote the original software. If you use this software in a product, an acknowledgment in the product "
             "documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as "
             "such, and must not be misrepresented as being the original software. 3. This notice may not be removed or "
             "altered from any source distribution."),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003 Permission is hereby granted, free of charge, to any "
                "person or organization obtaining a copy of the software and accompanying documentation covered by this license "
                "(the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare "
                "derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all "
                "subject to the following: The copyright notices in the Software and this entire statement, including the above "
                "license grant, this restriction and the following disclaimer, must be included in all copies of the Software, "
                "in whole or in part, and all derivative works of the Software, unless such copies or derivative works are "
                "solely in the form of machine-executable object code generated by a source language processor. THE SOFTWARE IS "
                "PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
                "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL "
                "THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, "
                "WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
                "OTHER DEALINGS IN THE SOFTWARE."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
                "http://www.boost.org/LICENSE_1_0.txt)"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
                  "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
                  "binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize "
                  "copyright laws, the author or authors of this software dedicate any and all copyright interest in the "
                  "software to the public domain. We make this dedication for the benefit of the public at large and to the "
                  "detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in "
                  "perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "
                  "\"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
                  "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE "
                  "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
                  "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For "
                  "more information, please refer to <https://unlicense.org>"),
    ("WTFPL", "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE Version 2, December 2004. Everyone is permitted to copy and "
              "distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name "
              "is changed. TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION 0. You just DO WHAT THE FUCK YOU "
              "WANT TO."),
    # lines that tell licences with like texts apart; those of MIT as they are usually wrapped, and whole
    ("MIT", "MIT License"), ("MIT", "The MIT License (MIT)"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
            "Software."),
    ("MIT", "copies or substantial portions of the Software."),
    # the endorsement clause as it is usually wrapped: what tells a file of three clauses from one of two, line by line
    ("BSD-3-Clause", "contributors may be used to endorse or promote products derived from"),
    ("BSD-3-Clause", _ENDORSE),
    ("BSD-4-Clause", _ADVERTISE),
    ("ISC", "copyright notice and this permission notice appear in all copies."),
    # openings that several licences share have the name of the one that asks for least
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met"),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted"),
]


def _gnu(subject: str, title: str, version: str, mark: str) -> str:
    """The notice that GNU licences ask for at the start of each file."""
    return (f"This {subject} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {title} "
            f"as published by the Free Software Foundation{',' if mark == ':' else ';'} either version {version} of the License, "
            f"or (at your option) any later version. This {subject} is distributed in the hope that it will be useful, but "
            "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
            f"See the GNU {title} for more details. You should have received a copy of the GNU {title} along with this "
            f"{subject}. If not, see <https://www.gnu.org/licenses/>.")


NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                   "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                   "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License."),
    *[(name, _gnu(subject, title, version, mark)) for name, title, version, mark, subjects in (
        ("GPL-2.0", "General Public License", "2", ";", ("program", "file")),
        ("GPL-3.0", "General Public License", "3", ":", ("program", "file")),
        ("LGPL-2.0", "Library General Public License", "2", ";", ("library",)),
        ("LGPL-2.1", "Lesser General Public License", "2.1", ";", ("library", "program")),
        ("LGPL-3.0", "Lesser General Public License", "3", ":", ("library", "program")),
        ("AGPL-3.0", "Affero General Public License", "3", ":", ("program",))) for subject in subjects],
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License version 2 as published by the Free Software Foundation."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not "
                "use this file except in compliance with the License. You may obtain a copy of the License at "
                "http://www.mozilla.org/MPL/"),
    *[(f"EPL-{v}", f"This program and the accompanying materials are made available under the terms of the Eclipse Public License "
                   f"{w} which accompanies this distribution, and is available at {url}") for v, w, url in (
        ("2.0", "2.0", "https://www.eclipse.org/legal/epl-2.0/"),
        ("1.0", "v1.0", "http://www.eclipse.org/legal/epl-v10.html"))],
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
]

#: The lines that a licence file starts with, the one that tells a version before the one that all versions share.
FIRST_LINES = [
    ("MIT-0", "MIT No Attribution"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"), ("Apache-2.0", "Version 2.0, January 2004"),
    ("LGPL-2.1", "Version 2.1, February 1999"), ("LGPL-2.0", "GNU LIBRARY GENERAL PUBLIC LICENSE"),
    ("LGPL-3.0", "This version of the GNU Lesser General Public License incorporates"),
    ("AGPL-3.0", "Version 3, 19 November 2007"), ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE"),
    ("GPL-2.0", "Version 2, June 1991"), ("GPL-3.0", "Version 3, 29 June 2007"), ("GPL-1.0", "Version 1, February 1989"),
    ("LGPL", "GNU Lesser General Public License"), ("GPL", "GNU General Public License"),
    ("GFDL-1.2", "Version 1.2, November 2002"), ("GFDL-1.3", "Version 1.3, 3 November 2008"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"), ("MPL-1.1", "Mozilla Public License Version 1.1"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"), ("EPL-1.0", "Eclipse Public License - v 1.0"),
]

_TITLES = [
    ("GPL-2.0", "GNU General Public License, version 2"), ("GPL-2.0", "GPLv2"), ("GPL-3.0", "GPLv3"),
    ("LGPL-2.1", "GNU Lesser General Public License, version 2.1"), ("LGPL-2.1", "LGPLv2.1"),
    ("LGPL-3.0", "GNU Lesser General Public License, version 3"), ("LGPL-3.0", "LGPLv3"),
    ("AGPL-3.0", "GNU Affero General Public License, version 3"), ("AGPL-3.0", "AGPLv3"),
    ("MPL-2.0", "Mozilla Public License, version 2.0"), ("EPL-2.0", "Eclipse Public License, version 2.0"),
    ("EPL-1.0", "Eclipse Public License, version 1.0"), ("BSL-1.0", "Boost Software License, version 1.0"),
    ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License"), ("ISC", "ISC License"),
    ("Artistic-2.0", "Artistic License 2.0"),  # not zlib: the word alone is mostly the library
]
TITLES = [(name, f"Licensed under the {title}.") for name, title in _TITLES]

_CC_WORDS = {"by": "Attribution", "nc": "NonCommercial", "sa": "ShareAlike", "nd": "NoDerivatives"}
CREATIVE_COMMONS = [
    t for kind in ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd") for version in ("4.0", "3.0", "2.0")
    for name, words in [(f"CC-{kind.upper()}-{version}", "-".join(_CC_WORDS[w] for w in kind.split("-")))]
    for t in ((name, f"Licensed under CC {kind.upper()} {version}."),
              (name, f"This work is licensed under a Creative Commons {words} {version} International License."),
              (name, f"https://creativecommons.org/licenses/{kind}/{version}/"))
] + [("CC0-1.0", "https://creativecommons.org/publicdomain/zero/1.0/"), ("CC0-1.0", "CC0 1.0 Universal")]

#: Identifiers of the SPDX list by the name that they get here: "only" and "or later" are one version.
_IDS = {i: i for i in """0BSD AFL-3.0 Apache-1.1 Apache-2.0 Artistic-1.0 Artistic-2.0 BSD-1-Clause BSD-2-Clause
    BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Clear BSD-4-Clause BSL-1.0 BUSL-1.1 BlueOak-1.0.0 CC0-1.0 CDDL-1.0 CDDL-1.1
    CECILL-2.1 CPL-1.0 ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 HPND ISC LPPL-1.3c MIT MIT-0 MPL-1.0 MPL-1.1 MPL-2.0 MS-PL
    MS-RL MulanPSL-2.0 NCSA ODbL-1.0 OFL-1.1 OSL-3.0 PHP-3.01 PSF-2.0 Python-2.0 SSPL-1.0 UPL-1.0 Unicode-3.0
    Unicode-DFS-2016 Unlicense WTFPL ZPL-2.1 Zlib""".split()}
_IDS |= {f"CC-{k}-{v}": f"CC-{k}-{v}" for k in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND") for v in ("3.0", "4.0")}
_IDS |= {name + end: name for name in ("GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "GFDL-1.2",
                                       "GFDL-1.3") for end in ("", "-only", "-or-later")}
_TAG = "SPDX-License-Identifier:"
#: An identifier that is one common word counts less than the tag, so that the word alone is no licence. The bare tag
#: is nearer than any of these where the identifier is not in the list, so that such a file is not named after another.
SPDX = [(name, f"{_TAG if '-' in i else _TAG + ' ' + _TAG} {i}") for i, name in _IDS.items()] + [("NOASSERTION", _TAG)]

FULL = [(name, _full(file)) for name, file in (
    ("Apache-2.0", "Apache-2.0"), ("GPL-1.0", "GPL-1"), ("GPL-2.0", "GPL-2"), ("GPL-3.0", "GPL-3"), ("LGPL-2.0", "LGPL-2"),
    ("LGPL-2.1", "LGPL-2.1"), ("LGPL-3.0", "LGPL-3"), ("MPL-1.1", "MPL-1.1"), ("MPL-2.0", "MPL-2.0"), ("CC0-1.0", "CC0-1.0"),
    ("Artistic-1.0", "Artistic"), ("GFDL-1.2", "GFDL-1.2"), ("GFDL-1.3", "GFDL-1.3"))]
# the Affero licence is GPL-3.0 under its own name, but for section 13
FULL.append(("AGPL-3.0", dict(FULL)["GPL-3.0"].replace("General Public License", "Affero General Public License")
             .replace("GENERAL PUBLIC LICENSE", "AFFERO GENERAL PUBLIC LICENSE") + _AFFERO))

MORE = [*SHORT, *NOTICES, *FIRST_LINES, *TITLES, *CREATIVE_COMMONS, *SPDX, *FULL]
