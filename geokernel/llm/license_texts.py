"""Texts of public licences and notices, by SPDX identifier.

Copyright lines are left out, as the canonical form drops them."""

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""

_BSD_HEAD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""

_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""

_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""

_ISC = f"""Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

{_ISC_WARRANTY}"""

_ZERO_BSD = f"""Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted.

{_ISC_WARRANTY}"""

_ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software. If you use this software
   in a product, an acknowledgment in the product documentation would be
   appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be
   misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""

_APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""

_GPL_NOTICE = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program. If not, see <https://www.gnu.org/licenses/>."""

KNOWN = {
    "MIT": _MIT,
    "MIT (titled)": f"MIT License\n\n{_MIT}",
    "MIT (notice)": "Released under the MIT License.",
    "ISC": _ISC,
    "ISC (titled)": f"ISC License\n\n{_ISC}",
    "0BSD": _ZERO_BSD,
    "BSD-2-Clause": f"{_BSD_HEAD}\n\n{_BSD_WARRANTY}",
    "BSD-2-Clause (titled)": f"BSD 2-Clause License\n\n{_BSD_HEAD}\n\n{_BSD_WARRANTY}",
    "BSD-3-Clause": f"{_BSD_HEAD}\n\n{_BSD_NAMES}\n\n{_BSD_WARRANTY}",
    "BSD-3-Clause (titled)": f"BSD 3-Clause License\n\n{_BSD_HEAD}\n\n{_BSD_NAMES}\n\n{_BSD_WARRANTY}",
    "Zlib": _ZLIB,
    "Apache-2.0 (header)": _APACHE_NOTICE,
    "Apache-2.0 (notice)": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-or-later (header)": _GPL_NOTICE,
    "GPL-3.0 (notice)": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-4.0 (notice)": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 (notice)": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0 (notice)": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0 (notice)": "This work is dedicated to the public domain under CC0 1.0.",
}

#: SHA-256 of the canonical form of full standard texts; "(terms)" is without what follows END OF
#: TERMS AND CONDITIONS.
STANDARD = {
    "Apache-2.0": "ef36af97727268b60fb709836c24580bed9887f649dba6f0fd9ef4b18232fd25",
    "Apache-2.0 (terms)": "119e2da0e9ec849d113a40405b338c1bbbd2ef9194c22bf2740fa4e195411c40",
    "Artistic-1.0-Perl": "e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2",
    "BSD-3-Clause-UC": "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651",
    "CC0-1.0": "cccf7894e1b9f4ba9f97728bf0c5baf9e07bc2ac93da7a51556451b1fb2b868e",
    "GFDL-1.2": "974d4803f32bc52585c91f1d63d572d8e11bf3d14744649accc62ae987441597",
    "GFDL-1.3": "34c73c47241aa82a5db0ec292e9a2c127d3bc8b07456d806aad74bbebcfc1f5d",
    "GPL-1.0": "df6be0ef8450813e8086ffa782c39595bbed54061f3073efbe78160084f5f2f3",
    "GPL-1.0 (terms)": "9679cb8f8a7c25e849b925136d793d1bec010b8b9270e6ba898e2cefcb3e1f6d",
    "GPL-2.0": "ada43b21b16dd64b4b8f1d9c2ab43ff16f75a8f0f835fc2f37a0c7e65f28d243",
    "GPL-2.0 (terms)": "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34",
    "GPL-3.0": "1c5db3a9706da330620b6cba254c3d98d654fc625c04908e63e64d0ade6861e3",
    "GPL-3.0 (terms)": "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636",
    "LGPL-2.0": "4401e0261a8caf4fd55eeb0e816fda06bbc9e4b2605767f5ffdf843a5c70e07e",
    "LGPL-2.0 (terms)": "96c47047421b3be5cae9a68c75f37fdcf07945fba0a1d6db6a3b57f9c70f75a0",
    "LGPL-2.1": "599d9303049b507aa89582ee08dd4ddaba298764648558e7bf8e78309807bfaa",
    "LGPL-2.1 (terms)": "a6742add8db4ff9ba6917da0bd1f95927436acfd65ae81933f1e9a859d38d9fa",
    "LGPL-3.0": "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be",
    "MPL-1.1": "d35837e2a25aa463ef610d84a745dd508a3e9c1424ea611c4c5939307e738d63",
    "MPL-2.0": "12274540925f246f7614a52b7ebddfbe0463ff1ab194088c554c73552c45582d",
}
