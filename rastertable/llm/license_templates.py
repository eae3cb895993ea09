"""License wording as templates with markup, and the short phrases that name a license.

``<<optional>> .. <</optional>>`` may be left out, ``<<words 1 8>>`` stands for that many words of any
kind. Everything else is mandatory and must match word by word, letters lowered, punctuation aside.
Fixed values: the wording of the public licenses and of their customary notices.
"""

from __future__ import annotations

#: Phrases whose places count as base results, with their labels.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

_WARRANTY_OF_MIT = """
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
<<optional>>NONINFRINGEMENT<</optional>><<optional>>NON-INFRINGEMENT<</optional>>. IN NO EVENT SHALL
<<words 1 12>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
DEALINGS IN THE SOFTWARE."""

_BSD_START = """
Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:
<<optional>>1.<</optional>> Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer.
<<optional>>2.<</optional>> Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution."""

_BSD_END = """
THIS SOFTWARE IS PROVIDED BY <<words 1 14>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL <<words 1 14>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING
IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_LICENSED = "<<optional>>is<</optional>> <<optional>>are<</optional>> <<optional>>made<</optional>> {} under <<optional>>the terms of<</optional>> <<optional>>the<</optional>>"


def _notices(wording: str) -> tuple[str, ...]:
    """A short notice with each of the usual verbs."""
    return tuple(_LICENSED.format(verb) + " " + wording for verb in ("licensed", "released", "available", "distributed"))


def _gnu(kind: str, version: str) -> tuple[str, ...]:
    wording = (f"GNU {kind} General Public License<<optional>>, as published by the Free Software Foundation<</optional>>"
               f"<<optional>>, either<</optional>> version {version}<<optional>>.0<</optional>>"
               "<<optional>> of the License<</optional>><<optional>>, or (at your option) any later version<</optional>>")
    terms = "redistribute it and/or modify it under the terms of the "
    return (*_notices(wording), terms + wording)


def _creative_commons(*elements: str) -> tuple[str, ...]:
    """Of any version ``x.0``."""
    return _notices("<<optional>>a<</optional>> CC " + " ".join(elements) + " <<words 1 1>> 0 <<optional>>license<</optional>>")


#: label -> its templates
TEMPLATES: dict[str, tuple[str, ...]] = {
    "mit": (
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice
        <<optional>>(including the next paragraph)<</optional>> shall be included in all copies or substantial
        portions of the Software.""" + _WARRANTY_OF_MIT,
        *_notices("MIT license"), "SPDX-License-Identifier: MIT"),
    "isc": (
        """Permission to use, copy, modify, <<optional>>and<</optional>><<optional>>and/or<</optional>> distribute this
        software for any purpose with or without fee is hereby granted, provided that the above copyright notice
        and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND <<words 1 10>>
        DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
        AND FITNESS. IN NO EVENT SHALL <<words 1 10>> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
        DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
        CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE
        OF THIS SOFTWARE.""", *_notices("ISC license"), "SPDX-License-Identifier: ISC"),
    "bsd-2": (_BSD_START + _BSD_END, *_notices("BSD 2 clause license"), "SPDX-License-Identifier: BSD-2-Clause"),
    "bsd-3": (
        _BSD_START + """<<optional>>3.<</optional>> Neither the name of <<words 1 14>> nor the names of its contributors
        may be used to endorse or promote products derived from this software without specific prior written
        permission.""" + _BSD_END, *_notices("BSD 3 clause license"), "SPDX-License-Identifier: BSD-3-Clause"),
    "zlib": (
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors
        be held liable for any damages arising from the use of this software. Permission is granted to anyone to
        use this software for any purpose, including commercial applications, and to alter it and redistribute it
        freely, subject to the following restrictions""", "SPDX-License-Identifier: Zlib"),
    "unlicense": (
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
        binary, for any purpose, commercial or non-commercial, and by any means""", "SPDX-License-Identifier: Unlicense"),
    "apache-2": (
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use
        <<optional>>this file<</optional>><<optional>>this work<</optional>> except in compliance with the License. You
        may obtain a copy of the License at <<words 1 12>> Unless required by applicable law or agreed to in writing,
        software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS
        OF ANY KIND, either express or implied.""",
        *_notices("Apache <<optional>>software<</optional>> license<<optional>>,<</optional>> <<optional>>version<</optional>> 2<<optional>>.0<</optional>>"),
        "SPDX-License-Identifier: Apache-2.0"),
    "mpl-2": (
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
        was not distributed with this file, You can obtain one at""",
        *_notices("Mozilla Public License <<optional>>version<</optional>> <<optional>>v<</optional>> 2<<optional>>.0<</optional>>"),
        "SPDX-License-Identifier: MPL-2.0"),
    "gpl-2": _gnu("", "2"),
    "gpl-3": _gnu("", "3"),
    "lgpl-2": _gnu("Lesser", "2<<optional>>.1<</optional>>") + _gnu("Library", "2"),
    "lgpl-3": _gnu("Lesser", "3"),
    "agpl-3": _gnu("Affero", "3"),
    "cc-by": _creative_commons("BY"),
    "cc-by-sa": _creative_commons("BY", "SA"),
    "cc-by-nd": _creative_commons("BY", "ND"),
    "cc-by-nc": _creative_commons("BY", "NC"),
    "cc-by-nc-sa": _creative_commons("BY", "NC", "SA"),
    "cc-by-nc-nd": _creative_commons("BY", "NC", "ND"),
}
