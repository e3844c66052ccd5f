"""Texts of license notices: lines, headers, whole short licenses, and tags built from identifiers."""

from __future__ import annotations

#: What a template's name ends with, behind the name of its license.
KINDS = ("header", "text", "line", "title", "sentence", "clause", "SPDX")

# The wording of license notices.
_NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law "
        "or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."
    ),
    "MIT": "Released under the MIT License",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
        "is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the Software."
    ),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "BSD-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain",
    "all-rights-reserved": "All rights reserved",
    "MIT-title": "The MIT License (MIT)",
    "BSD-line": "Released under the BSD License",
    "LGPL-header": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "AGPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "BSD-3-Clause-clause": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
        "from this software without specific prior written permission."
    ),
    "BSL-1.0-text": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
        "documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the "
        "Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do "
        "so, all subject to the following:"
    ),
    "Zlib-text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
        "damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including "
        "commercial applications, and to alter it and redistribute it freely"
    ),
    "EPL-2.0-sentence": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is "
        "available at https://www.eclipse.org/legal/epl-2.0"
    ),
    "CC0-1.0-sentence": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
}

# SPDX identifiers.
SPDX_IDS = [
    "0BSD", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-1.1", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause",
    "BSD-4-Clause", "BSL-1.0", "CC-BY-3.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-NC-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-ND-4.0",
    "CC-BY-SA-3.0", "CC-BY-SA-4.0", "CC0-1.0", "CDDL-1.0", "EPL-1.0", "EPL-2.0", "EUPL-1.2", "GPL-2.0", "GPL-2.0-only",
    "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later",
    "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MIT-0", "MPL-1.1", "MPL-2.0", "PostgreSQL", "Python-2.0", "Unlicense",
    "WTFPL", "Zlib",
]

# What Creative Commons calls the parts of a license.
_PARTS = {"BY": "Attribution", "NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}


def _creative_commons() -> dict[str, str]:
    """A line and a sentence of each license."""
    out = {}
    for parts in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        title = "-".join(_PARTS[p] for p in parts.split("-"))
        out[f"CC-{parts}-4.0"] = f"Licensed under CC {parts} 4.0"
        out[f"CC-{parts}-4.0-sentence"] = f"This work is licensed under a Creative Commons {title} 4.0 International License"
    return out


TEMPLATES = _NOTICES | _creative_commons() | {f"{i}-SPDX": f"SPDX-License-Identifier: {i}" for i in SPDX_IDS}


def license_of(name: str) -> str:
    """The license that the template ``name`` stands for."""
    first, _, last = name.rpartition("-")
    return first if first and last in KINDS else name
