"""Licence texts as they are found in the wild; none of them is in the test tables."""

import pytest

from tidemark.llm import license_scan
from tidemark.llm.license_texts import FULL

#: (a line or header, its licence)
NOTICES = [
    ("// SPDX-License-Identifier: MIT\nint x;", "MIT"), ("/* SPDX-License-Identifier: GPL-2.0-only */\nint x;", "GPL-2.0"),
    ("# SPDX-License-Identifier: Apache-2.0\nx = 1", "Apache-2.0"), ("# SPDX-License-Identifier: LGPL-2.1-or-later\nx = 1", "LGPL-2.1"),
    ("// SPDX-License-Identifier: BSD-2-Clause\nint x;", "BSD-2-Clause"),
    ("This module is\nlicensed under the BSD 3-Clause License\n", "BSD-3-Clause"),
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"), ("Licensed under CC BY-ND 4.0.", "CC-BY-ND-4.0"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
    ("# Copyright (C) 1999 A. Writer\n#\n# This library is free software; you can redistribute it and/or\n# modify it under the terms "
     "of the GNU Lesser General Public\n# License as published by the Free Software Foundation; either\n# version 2.1 of the License, "
     "or (at your option) any later version.\n#\n# This library is distributed in the hope that it will be useful,\n# but WITHOUT ANY "
     "WARRANTY; without even the implied warranty of\n# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU\n# Lesser "
     "General Public License for more details.\n#\n# You should have received a copy of the GNU Lesser General Public\n# License along "
     "with this library; if not, write to the Free Software\n# Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA  "
     "02110-1301  USA\nx = 1", "LGPL-2.1"),
    ("zlib\nlibpng\n", None), ("we like the general public and its version of a license", None),
]
BSD_2 = """Copyright (c) 2015, A. Writer
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
%s
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES.
"""
CLAUSE_3 = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
MIT = """Copyright (c) 2014 A. Writer

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in
all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND.
"""


def full(name):
    """The body of a long licence, without its title."""
    return "\n".join(dict(FULL)[name].split("\n")[12:])


@pytest.fixture(scope="module")
def scanned(spark, sf):
    files = {f"n{i}/x": text for i, (text, _) in enumerate(NOTICES)}
    files |= {"unlisted/x": "// SPDX-License-Identifier: Foo-9.9\nint x;", "mit/LICENSE": MIT, "two/LICENSE": BSD_2 % "", "three/LICENSE": BSD_2 % CLAUSE_3}
    files |= {f"{n}/COPYING": full(n) for n in ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "AGPL-3.0", "MPL-2.0")}
    files |= {f.rsplit("/", 1)[0] + "/src/a.py": "code = 1" for f in list(files)}
    others = [(f"docs/{r.doc_id}", r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = spark.createDataFrame([*files.items(), *others], "path string, text string")
    return {r.path: r for r in license_scan.scan(rows).filter("path not like 'docs/%'").collect()}


def test_notices_and_tags(scanned):
    assert [scanned[f"n{i}/x"].own_license for i in range(len(NOTICES))] == [name for _, name in NOTICES]
    assert scanned["unlisted/x"].own_license in (None, "NOASSERTION")  # how common the tag is decides


def test_licence_files_and_what_lies_below_them(scanned):
    for folder, name in (("mit", "MIT"), ("two", "BSD-2-Clause"), ("three", "BSD-3-Clause")):
        got = scanned[f"{folder}/LICENSE"]
        assert (got.is_license_file, got.own_license, scanned[f"{folder}/src/a.py"].license) == (True, name, name)
    for name in ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "AGPL-3.0", "MPL-2.0"):
        assert scanned[f"{name}/COPYING"].is_license_file and scanned[f"{name}/src/a.py"].license == name


def test_terms_beside_underscores(spark):
    rows = [("a/x", "_MIT License_"), ("b/x", "__Released under the MIT_License__"), ("c/x", "MITx Licenses")]
    got = license_scan.scan(spark.createDataFrame(rows, "path string, text string")).collect()
    assert {r.path: r.own_license for r in got} == {"a/x": "MIT", "b/x": "MIT", "c/x": None}
