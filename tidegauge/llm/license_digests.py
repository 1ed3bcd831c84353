"""Canonical digests of entire licences that are too long to ship, and standard notices, by SPDX name.

The digests are taken with `licenses.known_digests` from the texts that Debian has in /usr/share/common-licenses: entire files, and for those
with an appendix also the part up to the line that ends the terms, with and without that line.
"""

WHOLE = (
    ("Apache-2.0", "36f14b0c54db15647edba3de92ef39ee60a8ab767e1eec3e53a2cf3874d5d64a"),  # Apache-2.0
    ("Apache-2.0", "e66a0923f5257294fb07aefb18488a775c1a50ffb4724e588a189afaf5b7dbc5"),  # Apache-2.0, to the end of its terms
    ("Apache-2.0", "8916993bf300b1ceca4f43291d11582752cb472c47169d101fc18114e9504af7"),  # Apache-2.0, before that line
    ("Artistic-1.0-Perl", "065afd054b7b3891100d80895d113a7c684cbc25122fa1c526244c852fe5a9ba"),  # Artistic
    ("BSD-3-Clause", "b271137c6dc5158dc44f351a2392dc48ada8018a7e253b93ea3d51724b3e40b4"),  # BSD
    ("CC0-1.0", "97098b9d4d582064b16255ff38f4b45a41ecce484eb98a46cdb15423d6de9f85"),  # CC0-1.0
    ("GFDL-1.2-only", "d50c72f802fd65b68fefdacc125a5dc5d60d876b08089cc01d65e48fc4ddee5e"),  # GFDL-1.2
    ("GFDL-1.3-only", "c136842c3bb94c66f9158ddea107c935e305b1f3d74c98797ad031c4abf1d065"),  # GFDL-1.3
    ("GPL-1.0-only", "e364aad3db413655fde3de60fabbec1cf77c7bd3b2944d17cea899a1f72d7d60"),  # GPL-1
    ("GPL-1.0-only", "4d8661076b271388204b513334f465af9649e35bb9dfc968f5fc2af75fff36a6"),  # GPL-1, to the end of its terms
    ("GPL-1.0-only", "10432111b8d3d37d7de54c5df4d285fd692e6eeaa9196224dba390cc24d6789b"),  # GPL-1, before that line
    ("GPL-2.0-only", "6375475ed49478604fcb8c902de9f613f0ea85cb0c9741fa7a45619c488ed90b"),  # GPL-2
    ("GPL-2.0-only", "2b5dbc9472da3bc5519b8ecb2f9a8d542a84232dee69b88695bfa44b1f32a911"),  # GPL-2, to the end of its terms
    ("GPL-2.0-only", "e6da5b50589df55fc0b450887ed02d9dd7e85695a7988e2446ce5471154ba8e2"),  # GPL-2, before that line
    ("GPL-3.0-only", "399346df15b08b3a2a565a06250ed30a7e4d574ea5731f00fc86c8b2f8976017"),  # GPL-3
    ("GPL-3.0-only", "c75e81a34a007deb24a91ad867b30cad06864976e1c1827d68984da3881e5dbd"),  # GPL-3, to the end of its terms
    ("GPL-3.0-only", "318fb0bcad0bb378dd1069b02f602505daf3e4e65d93185f4d2d7c21c821ee0f"),  # GPL-3, before that line
    ("LGPL-2.0-only", "d0f63e6e433c39ca404c5b07fd50cd5ed68e4798effaa938b128c99e17ae60e0"),  # LGPL-2
    ("LGPL-2.0-only", "07d0fd4db5feea275c2d1835863a165d0e4b4ac86cc19e495e2c74ec250c52cc"),  # LGPL-2, to the end of its terms
    ("LGPL-2.0-only", "d4d29fdef217ed5b5695cc50146efc75c0903bbadbee010ef1a57b4cf72a66f8"),  # LGPL-2, before that line
    ("LGPL-2.1-only", "00cac975b1dd6f793b3f024aa244e01bf63ecc4db816979593bdb026e8fa5120"),  # LGPL-2.1
    ("LGPL-2.1-only", "4995c2e9d970b57711085cbfc0b7ca42ade195d279b3d8c244c1efb53826078c"),  # LGPL-2.1, to the end of its terms
    ("LGPL-2.1-only", "37f2cd032332ffe201fffd647f624754da0e3a8799d2811d64542db69110d56e"),  # LGPL-2.1, before that line
    ("LGPL-3.0-only", "9111884d93a72b30a3d024876dab3d755949ac2cfab230268a4169a93b86560c"),  # LGPL-3
    ("MPL-1.1", "5757c5a00244790c882be9db82495506c636f7b52b7ec97d0d3e44d96c463bb6"),  # MPL-1.1
    ("MPL-2.0", "88b06c62211af6dc8c37d9eece56c91b643d4359669fbd9f658f1945205c47bb"),  # MPL-2.0
)

_APACHE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    "You may obtain a copy of the License at\nhttp://www.apache.org/licenses/LICENSE-2.0\n",
    'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" '
    "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
    "governing permissions and limitations under the License.",
)
_MPL = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "If a copy of the MPL was not distributed with this file, You can obtain one at",
)
_GNU = """{it} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} as published by the
Free Software Foundation; either version {version} of the License, or (at your option) any later version.

{it} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} for more details.

You should have received a copy of the GNU {kind} along with this {last}. {where}"""
_WHERE = ("", "If not, see <https://www.gnu.org/licenses/>.")
_GNU_NAMES = (
    ("GPL-2.0-or-later", "2", "This program", "program", "General Public License"),
    ("GPL-3.0-or-later", "3", "This program", "program", "General Public License"),
    ("LGPL-2.1-or-later", "2.1", "This library", "library", "Lesser General Public License"),
    ("LGPL-3.0-or-later", "3", "This library", "library", "Lesser General Public License"),
    ("AGPL-3.0-or-later", "3", "This program", "program", "Affero General Public License"),
)
_TAGGED = (
    *dict.fromkeys(name for name, _ in WHOLE), *(row[0] for row in _GNU_NAMES), "0BSD", "AGPL-3.0-only", "BSD-2-Clause", "BSL-1.0",
    "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "EPL-2.0", "ISC", "MIT", "Unlicense", "Zlib",
)

STANDARD_NOTICES = (
    ("Apache-2.0", " ".join(_APACHE)),
    ("Apache-2.0", _APACHE[0]),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("MPL-2.0", f"{_MPL[0]} {_MPL[1]} http://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", f"{_MPL[0]} {_MPL[1]} https://www.mozilla.org/MPL/2.0/."),
    ("MPL-2.0", _MPL[0]),
    *(
        (name, _GNU.format(it=it, kind=kind, version=version, last=last, where=where))
        for name, version, it, last, kind in _GNU_NAMES
        for where in _WHERE
    ),
    *((name, f"SPDX-License-Identifier: {name}") for name in _TAGGED),
)
