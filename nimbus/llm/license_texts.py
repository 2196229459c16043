"""Titles, tags, statements, file headers and texts of common licences.

``TITLES`` are compared with whole lines, the others with windows of words,
wherever lines break. ``OPENINGS`` begin a licence's text: a file that starts
with one is a licence file, however long the text is."""

from __future__ import annotations

TITLES = [
    ("Apache", "Apache License"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("GPL", "GNU General Public License"),
    ("ISC", "ISC License"),
    ("MIT", "MIT License"),
    ("MIT", "The MIT License"),
    ("MIT", "The MIT License (MIT)"),
]

# SPDX identifiers, as "SPDX-License-Identifier: <id>".
TAGS = ["AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-NC-4.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-3.0", "MIT", "MPL-2.0"]

STATEMENTS = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("Proprietary", "All rights reserved"),
]

_GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0}General Public
License as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later
version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0}General Public License for more details."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN
NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS;
OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

TEXTS = [
    ("AGPL-3.0", _GNU.format("Affero ", 3)),
    ("GPL-2.0", _GNU.format("", 2)),
    ("GPL-3.0", _GNU.format("", 3)),
    ("LGPL-3.0", _GNU.format("Lesser ", 3)),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable
law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations
under the License."""),
    ("BSD-2-Clause", f"{_BSD} {_BSD_END}"),
    ("BSD-3-Clause", f"""{_BSD} 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission. {_BSD_END}"""),
    ("CC-BY-NC-4.0", """This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License. To view a
copy of this license, visit http://creativecommons.org/licenses/by-nc/4.0/"""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE
AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO
EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING
FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use,
copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included
in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
]

OPENINGS = [
    ("AGPL-3.0", """The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically
designed to ensure cooperation with the community in the case of network server software. The licenses for most software and other
practical works are designed to take away your freedom to share and change the works. By contrast, our General Public Licenses are
intended to guarantee your freedom to share and change all versions of a program--to make sure it remains free software for all its
users."""),
    ("Apache-2.0", """TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. "License" shall mean the terms and
conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document. "Licensor" shall mean the
copyright owner or entity authorized by the copyright owner that is granting the License. "Legal Entity" shall mean the union of the
acting entity and all other entities that control, are controlled by, or are under common control with that entity."""),
    ("CC-BY-NC-4.0", """By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of
this Creative Commons Attribution-NonCommercial 4.0 International Public License ("Public License"). To the extent this Public License
may be interpreted as a contract, You are granted the Licensed Rights in consideration of Your acceptance of these terms and
conditions, and the Licensor grants You such rights in consideration of benefits the Licensor receives from making the Licensed
Material available under these terms and conditions."""),
    ("GPL-2.0", """The licenses for most software are designed to take away your freedom to share and change it. By contrast, the GNU
General Public License is intended to guarantee your freedom to share and change free software--to make sure the software is free for
all its users. This General Public License applies to most of the Free Software Foundation's software and to any other program whose
authors commit to using it."""),
    ("GPL-3.0", """The GNU General Public License is a free, copyleft license for software and other kinds of works. The licenses for most
software and other practical works are designed to take away your freedom to share and change the works. By contrast, the GNU General
Public License is intended to guarantee your freedom to share and change all versions of a program--to make sure it remains free
software for all its users."""),
]

# (license, kind, text) of all.
PATTERNS = [(k, "title", x) for k, x in TITLES] + [(k, "tag", f"SPDX-License-Identifier: {k}") for k in TAGS]
PATTERNS += [(k, "said", x) for k, x in STATEMENTS + TEXTS] + [(k, "opening", x) for k, x in OPENINGS]
