"""License notices and short license texts that scans look for."""

_NO_WARRANTY = """
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES
OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_BSD_CONDITIONS = """
Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: 1. Redistributions of source code must retain the
above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in
binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""

TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License.""",
    "BSD-2-Clause": _BSD_CONDITIONS,
    "BSD-3-Clause": _BSD_CONDITIONS + """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse
or promote products derived from this software without specific prior written permission.""",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": """
This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License,
or (at your option) any later version. This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "ISC": """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
is hereby granted, provided that the above copyright notice and this permission notice appear in all
copies.""",
    "MIT notice": "Released under the MIT License.",
    "MIT": """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,
and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions: The above copyright notice and this permission notice shall be
included in all copies or substantial portions of the Software.""" + _NO_WARRANTY,
    "MPL-2.0 header": """
This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "MPL-1.1 notice": "The contents of this file are subject to the Mozilla Public License Version 1.1.",
    "Apache-1.1 notice": "Licensed under the Apache License, Version 1.1.",
    "BSD notice": "Released under the BSD License.",
    "CC-BY-SA-4.0 notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-ND-4.0 notice": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "CC-BY-NC-4.0 long notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-4.0 short notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 short notice": "Licensed under CC BY-SA 4.0.",
}

# Siblings that differ from a template in its name or version.
for _name, _from, _changes in (
        ("GPL-2.0", "GPL-3.0", {"version 3": "version 2"}),
        ("LGPL-3.0", "GPL-3.0", {"GNU\nGeneral": "GNU Lesser General", "GNU General": "GNU Lesser General"}),
        ("LGPL-2.1", "LGPL-3.0", {"version 3": "version 2.1"}),
        ("AGPL-3.0", "GPL-3.0", {"GNU\nGeneral": "GNU Affero General", "GNU General": "GNU Affero General"})):
    for _kind in ("notice", "header"):
        _text = TEMPLATES[f"{_from} {_kind}"]
        for _old, _new in _changes.items():
            _text = _text.replace(_old, _new)
        TEMPLATES[f"{_name} {_kind}"] = _text

#: Runs of words that have to be in a hit as they are: the license's name and version.
REQUIRED = {
    "Apache-2.0 notice": ("apache", "2.0"), "Apache-2.0 header": ("apache", "2.0"),
    "Apache-1.1 notice": ("apache", "1.1"), "BSD notice": ("bsd",), "MIT notice": ("mit",),
    "CC-BY-4.0 notice": ("creative commons attribution", "4.0"),
    "CC-BY-SA-4.0 notice": ("creative commons attribution", "sharealike", "4.0"),
    "CC-BY-ND-4.0 notice": ("creative commons attribution", "noderivatives", "4.0"),
    "CC-BY-NC-4.0 long notice": ("creative commons attribution", "noncommercial", "4.0"),
    "CC-BY-4.0 short notice": ("cc by", "4.0"), "CC-BY-SA-4.0 short notice": ("cc by", "sa", "4.0"),
    "CC-BY-NC-4.0 notice": ("cc by", "nc", "4.0"),
    "MPL-2.0 header": ("mozilla", "2.0"), "MPL-1.1 notice": ("mozilla", "1.1"),
    **{f"{_name} {_kind}": ("gnu", *_words) for _kind in ("notice", "header") for _name, _words in (
        ("GPL-2.0", ("2",)), ("GPL-3.0", ("3",)), ("LGPL-2.1", ("lesser", "2.1")),
        ("LGPL-3.0", ("lesser", "3")), ("AGPL-3.0", ("affero", "3")))},
}

#: Words that make another license of one with required words, unless its template has them.
VARIANTS = "sharealike share alike noncommercial commercial noderivatives noderivs derivatives nc nd sa lesser affero"
