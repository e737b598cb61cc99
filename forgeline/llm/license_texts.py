"""Wording of well-known license notices: whole notices, and the parts that are often quoted alone.

A whole notice has more words than its parts, so where it stands it is the one that is reported. Parts
that relatives share have the name of the family (`BSD`, `GPL`). Relatives that differ by a word or a number have a
notice each, so that the better match is the right one.
"""

from __future__ import annotations

_APACHE = ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
           "compliance with the License. You may obtain a copy of the License at "
           "http://www.apache.org/licenses/LICENSE-2.0")
_APACHE_REST = ("Unless required by applicable law or agreed to in writing, software distributed under the License is "
                'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
                "See the License for the specific language governing permissions and limitations under the License.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met")
_BSD_CLAUSES = ("1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this "
                "list of conditions and the following disclaimer in the documentation and/or other materials provided with "
                "the distribution.")
_BSD_NAMES = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
              "promote products derived from this software without specific prior written permission.")
_BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted")
_ISC_NOTICE = ", provided that the above copyright notice and this permission notice appear in all copies."
_ISC_DISCLAIMER = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
    "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE.")
_MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software")
_MIT_PERSONS = ", and to permit persons to whom the Software is furnished to do so"
_MIT_NOTICE = (", subject to the following conditions: The above copyright notice and this permission notice shall be "
               "included in all copies or substantial portions of the Software.")
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS {0}BE "
    "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
    "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_MIT_DISCLAIMER = _AS_IS.format("OR COPYRIGHT HOLDERS ")
_MPL = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
_MPL_REST = "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
_UNLICENSE = "This is free and unencumbered software released into the public domain."
_UNLICENSE_REST = (
    "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or "
    "as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize "
    "copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the "
    "public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and "
    "successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future "
    f"rights to this software under copyright law. {_AS_IS.format('')} For more information, please refer to "
    "https://unlicense.org/")


def _gnu(name: str, title: str, versions: tuple[str, ...]) -> list[tuple[str, str]]:
    terms = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    publisher = "as published by the Free Software Foundation"
    rest = ("This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
            f"warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {title} for more details. You should "
            f"have received a copy of the GNU {title} along with this program. If not, see https://www.gnu.org/licenses/.")
    out = [(name, f"This work is licensed under the GNU {title}."), (name, f"{terms}{title} {publisher}"), (name, rest)]
    for version in versions:
        full = version if "." in version else f"{version}.0"
        only = f"{terms}{title} version {version} {publisher}."
        later = f"{terms}{title} {publisher}, either version {version} of the License, or (at your option) any later version."
        out += [(f"{name}-{full}", f"This work is licensed under the GNU {title}, version {version}."),
                (f"{name}-{full}", only), (f"{name}-{full}", f"{only} {rest}"),
                (f"{name}-{full}-or-later", later), (f"{name}-{full}-or-later", f"{later} {rest}")]
    return out


def _creative_commons(marks: str, title: str) -> list[tuple[str, str]]:
    short = [(f"CC-{marks}-{v}", f"Licensed under CC {marks} {v}.") for v in ("1.0", "2.0", "2.5", "3.0", "4.0")]
    return short + [(f"CC-{marks}-{v.split()[0]}", f"This work is licensed under a Creative Commons {title} {v} License.")
                    for v in ("3.0 Unported", "4.0 International")]


# The wording of well-known license notices.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("0BSD", f"{_ISC}."),
    ("0BSD", f"{_ISC}. {_ISC_DISCLAIMER}"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", _APACHE_REST),
    ("Apache-2.0", f"{_APACHE} {_APACHE_REST}"),
    ("BSD", _BSD),
    ("BSD", _BSD_CLAUSES),
    ("BSD", _BSD_DISCLAIMER),
    ("BSD-2-Clause", f"{_BSD}: {_BSD_CLAUSES} {_BSD_DISCLAIMER}"),
    ("BSD-2-Clause", f"{_BSD_CLAUSES} {_BSD_DISCLAIMER}"),
    ("BSD-3-Clause", f"{_BSD}: {_BSD_CLAUSES} {_BSD_NAMES} {_BSD_DISCLAIMER}"),
    ("BSD-3-Clause", f"{_BSD_CLAUSES} {_BSD_NAMES} {_BSD_DISCLAIMER}"),
    *_creative_commons("BY", "Attribution"),
    *_creative_commons("BY-NC", "Attribution-NonCommercial"),
    *_creative_commons("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
    *_creative_commons("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    *_creative_commons("BY-ND", "Attribution-NoDerivatives"),
    *_creative_commons("BY-SA", "Attribution-ShareAlike"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring "
                "rights to this work."),
    *_gnu("AGPL", "Affero General Public License", ("3",)),
    *_gnu("GPL", "General Public License", ("2", "3")),
    *_gnu("LGPL", "Lesser General Public License", ("2.1", "3")),
    ("ISC", _ISC + _ISC_NOTICE),
    ("ISC", _ISC_DISCLAIMER),
    ("ISC", f"{_ISC}{_ISC_NOTICE} {_ISC_DISCLAIMER}"),
    ("MIT", "Released under the MIT License."),
    ("MIT", f"{_MIT_NOTICE} {_MIT_DISCLAIMER}"),
    ("MIT", f"{_MIT}{_MIT_PERSONS}{_MIT_NOTICE} {_MIT_DISCLAIMER}"),
    ("MIT", _MIT),
    ("MIT-0", f"{_MIT}{_MIT_PERSONS}. {_MIT_DISCLAIMER}"),
    ("MPL-2.0", _MPL),
    ("MPL-2.0", f"{_MPL} {_MPL_REST}"),
    ("MPL-2.0", _MPL_REST),
    ("Proprietary", "All rights reserved."),
    ("Unlicense", _UNLICENSE),
    ("Unlicense", _UNLICENSE_REST),
    ("Unlicense", f"{_UNLICENSE} {_UNLICENSE_REST}"),
)
