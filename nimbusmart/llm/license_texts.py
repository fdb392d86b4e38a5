"""Wordings of common licenses, by their SPDX names with the form after a dash.

Notices in their usual words, and passages of the license texts that tell them
from others: where two licenses differ in a few words only, a template is so
short that those words make up more than a fifth of its 5-word shingles.
"""

NOTICES = (
    ("MIT-licensed", "Licensed under the MIT License"),
    ("MIT-distributed", "Distributed under the MIT License"),
    ("MIT-terms", "under the terms of the MIT License"),
    ("MIT-body", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("Apache-2.0-short", "Licensed under the Apache License 2.0"),
    ("Apache-2.0-terms", "under the terms of the Apache License, Version 2.0"),
    ("Apache-2.0-body", "2. Grant of Copyright License. Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form."),
    ("GPL-2.0-header", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or"),
    ("GPL-2.0-only", "under the terms of the GNU General Public License version 2 as published by the Free Software Foundation"),
    ("GPL-2.0", "under the GNU General Public License, version 2"),
    ("GPL-2.0-body", "0. This License applies to any program or other work which contains a notice placed by the copyright holder saying it may be distributed under the terms of this General Public License. The \"Program\", below, refers to any such program or work, and a \"work based on the Program\" means either the Program or any derivative work under copyright law: that is to say, a work containing the Program or a portion of it, either verbatim or with modifications and/or translated into another language. (Hereinafter, translation is included without limitation in the term \"modification\".) Each licensee is addressed as \"you\"."),
    ("GPL-3.0-only", "under the terms of the GNU General Public License version 3 as published by the Free Software Foundation"),
    ("GPL-3.0-body", "Notwithstanding any other provision of this License, you have permission to link or combine any covered work with a work licensed under version 3 of the GNU Affero General Public License into a single combined work, and to convey the resulting work. The terms of this License will continue to apply to the part which is the covered work, but the special requirements of the GNU Affero General Public License, section 13, concerning interaction through a network will apply to the combination as such."),
    ("LGPL-2.1-header", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License"),
    ("LGPL-3.0-header", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("LGPL-2.1", "under the GNU Lesser General Public License, version 2.1"),
    ("LGPL-3.0", "the GNU Lesser General Public License, version 3"),
    ("LGPL-2.1-body", "0. This License Agreement applies to any software library or other program which contains a notice placed by the copyright holder or other authorized party saying it may be distributed under the terms of this Lesser General Public License (also called \"this License\"). Each licensee is addressed as \"you\"."),
    ("LGPL-3.0-body", "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License, supplemented by the additional permissions listed below."),
    ("AGPL-3.0-header", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("AGPL-3.0", "licensed under the GNU Affero General Public License, version 3"),
    ("AGPL-3.0-body", "Notwithstanding any other provision of this License, if you modify the Program, your modified version must prominently offer all users interacting with it remotely through a computer network (if your version supports such interaction) an opportunity to receive the Corresponding Source of your version by providing access to the Corresponding Source from a network server at no charge, through some standard or customary means of facilitating copying of software."),
    ("BSD-2-Clause", "materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE"),
    ("BSD-3-Clause", "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("BSD-2-Clause-licensed", "Licensed under the BSD 2-Clause License"),
    ("BSD-3-Clause-licensed", "Licensed under the BSD 3-Clause License"),
    ("BSD-disclaimer", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("MPL-2.0-notice", "If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("MPL-2.0-licensed", "licensed under the Mozilla Public License, version 2.0"),
    ("MPL-2.0-body", "You may create and distribute a Larger Work under terms of Your choice, provided that You also comply with the requirements of this License for the Covered Software. If the Larger Work is a combination of Covered Software with a work governed by one or more Secondary Licenses, and the Covered Software is not Incompatible With Secondary Licenses, this License permits You to additionally distribute such Covered Software under the terms of such Secondary License(s), so that the recipient of the Larger Work may, at their option, further distribute the Covered Software under the terms of either this License or such Secondary License(s)."),
    ("ISC-licensed", "Licensed under the ISC License"),
    ("ISC-body", "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS"),
    ("EPL-1.0", "made available under the terms of the Eclipse Public License v1.0"),
    ("EPL-2.0", "made available under the terms of the Eclipse Public License v. 2.0"),
    ("EPL-2.0-plain", "made available under the terms of the Eclipse Public License 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense-body", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("CC0-1.0-licensed", "Licensed under CC0 1.0 Universal"),
    ("CC0-1.0-body", "The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and Related Rights (defined below) upon the creator and subsequent owner(s) (each and all, an \"owner\") of an original work of authorship and/or a database (each, a \"Work\")."),
)

_KINDS = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives", "BY-NC": "Attribution-NonCommercial",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
CREATIVE_COMMONS = tuple(
    row
    for kind, name in _KINDS.items()
    for version, port in (("4.0", "International"), ("3.0", "Unported"))
    for row in (
        (f"CC-{kind}-{version}-notice", f"licensed under a Creative Commons {name} {version} {port} License"),
        (f"CC-{kind}-{version}-named", f"licensed under the Creative Commons {name} {version} {port} License"),
        (f"CC-{kind}-{version}-short", f"Licensed under CC {kind} {version}"),
    )
    if row[0] != "CC-BY-NC-4.0-short"  # one of the first templates
)
