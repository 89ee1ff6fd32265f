"""Known licence texts and one-line notices, as published.

Fixed values: the wording is what makes the licence. Holder and year lines are
left out; the scan drops them from documents as well.
"""

_AS_IS_MIT = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
    "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN "
    "AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE "
    "OR OTHER DEALINGS IN THE SOFTWARE."
)
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without '
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so"
)
_AS_IS_BSD = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
    "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
    "DAMAGE."
)
_BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met:"
)
_BSD_1 = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer."
)
_BSD_2 = (
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission."
)
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted"
)
_AS_IS_ISC = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
    "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
    "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
    "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
    "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)

# --- Fixed values: (identifier, title, text) of whole licences. ---
LICENCES: list[tuple[str, str, str]] = [
    ("MIT", "MIT License", f"{_MIT_GRANT}, subject to the following conditions:\nThe above copyright notice and this "
     f"permission notice shall be included in all copies or substantial portions of the Software.\n{_AS_IS_MIT}"),
    ("MIT-0", "MIT No Attribution", f"{_MIT_GRANT}.\n{_AS_IS_MIT}"),
    ("ISC", "ISC License", f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear "
     f"in all copies.\n{_AS_IS_ISC}"),
    ("0BSD", "Zero-Clause BSD", f"{_ISC_GRANT}.\n{_AS_IS_ISC}"),
    ("BSD-2-Clause", "BSD 2-Clause License", f"{_BSD_GRANT}\n{_BSD_1}\n{_BSD_2}\n{_AS_IS_BSD}"),
    ("BSD-3-Clause", "BSD 3-Clause License", f"{_BSD_GRANT}\n{_BSD_1}\n{_BSD_2}\n{_BSD_3}\n{_AS_IS_BSD}"),
    ("Zlib", "zlib License",
     "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
     "held liable for any damages arising from the use of this software.\nPermission is granted to anyone to use "
     "this software for any purpose, including commercial applications, and to alter it and redistribute it freely, "
     "subject to the following restrictions:\n1. The origin of this software must not be misrepresented; you must "
     "not claim that you wrote the original software. If you use this software in a product, an acknowledgment in "
     "the product documentation would be appreciated but is not required.\n2. Altered source versions must be "
     "plainly marked as such, and must not be misrepresented as being the original software.\n3. This notice may "
     "not be removed or altered from any source distribution."),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003",
     "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
     'and accompanying documentation covered by this license (the "Software") to use, reproduce, display, '
     "distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit "
     "third-parties to whom the Software is furnished to do so, all subject to the following:\nThe copyright notices "
     "in the Software and this entire statement, including the above license grant, this restriction and the "
     "following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative "
     "works of the Software, unless such copies or derivative works are solely in the form of machine-executable "
     'object code generated by a source language processor.\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF '
     "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
     "PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING "
     "THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING "
     "FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("Unlicense", "The Unlicense",
     "This is free and unencumbered software released into the public domain.\nAnyone is free to copy, modify, "
     "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
     "for any purpose, commercial or non-commercial, and by any means.\nIn jurisdictions that recognize copyright "
     "laws, the author or authors of this software dedicate any and all copyright interest in the software to the "
     "public domain. We make this dedication for the benefit of the public at large and to the detriment of our "
     "heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all "
     "present and future rights to this software under copyright law.\n"
     'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED '
     "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
     "THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
     "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE "
     "SOFTWARE.\nFor more information, please refer to <http://unlicense.org/>"),
    ("Apache-2.0", "",
     'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
     "with the License. You may obtain a copy of the License at\nhttp://www.apache.org/licenses/LICENSE-2.0\nUnless "
     "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
     'an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
     "the specific language governing permissions and limitations under the License."),
    ("GPL-3.0-or-later", "",
     "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
     "option) any later version.\nThis program is distributed in the hope that it will be useful, but WITHOUT ANY "
     "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
     "GNU General Public License for more details.\nYou should have received a copy of the GNU General Public "
     "License along with this program. If not, see <https://www.gnu.org/licenses/>."),
]

# --- Fixed values: SHA-256 of the canonical form (see ``licenses``) of whole licences, from
# the copies in Debian's /usr/share/common-licenses; where a text has an appendix on how to
# apply it, a second digest is without it. ---
DIGESTS: list[tuple[str, str]] = [
    ("Apache-2.0", "75acde0fb516a7ba4597dfc23680cf78281f7fae7f3b74a78e06ef83c1c375c6"),
    ("Apache-2.0", "f9138026e58bdb767e6c6e974637ff9aacbaedf2695e30fef144e5d7d84448ff"),
    ("GPL-2.0-only", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-2.0-only", "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34"),
    ("GPL-3.0-only", "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a"),
    ("GPL-3.0-only", "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636"),
    ("LGPL-2.1-only", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-2.1-only", "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4"),
    ("LGPL-3.0-only", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "cbbde7eeab9b4d180dc00b34252f800e97fb1cddbab38ed8c0c73b956dc2cbf6"),
    ("MPL-2.0", "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
]

# --- Fixed values: one-line notices, by licence identifier. ---
NOTICES: list[tuple[str, str]] = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0-only", "Licensed under the GNU General Public License, version 2."),
    ("GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-only"),
    ("LGPL-3.0-only", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0-only", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
]

# --- Fixed values: equivalent spellings, applied in this order to text that is
# lower case with single spaces for punctuation. ---
SPELLINGS: list[tuple[str, str]] = [
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"),
    ("acknowledgement", "acknowledgment"),
    ("judgement", "judgment"),
    ("organisation", "organization"),
    ("recognise", "recognize"),
    ("favour", "favor"),
    ("fulfilment", "fulfillment"),
    ("whilst", "while"),
    ("https", "http"),
]
