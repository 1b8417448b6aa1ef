"""Notices by licence family, as licences and their users word them, names and identifiers, and sentences that use such words for other things."""

# Texts of public licences.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
        "This software is distributed under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file distributed with this work for additional information regarding copyright ownership. The ASF licenses this file to you under the Apache License, Version 2.0.",
        "The project is released under the Apache 2.0 license.",
        "This project is licensed under the Apache License, Version 2.0; see the LICENSE file for details.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
        "This project is licensed under the terms of the MIT license.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY.",
        "SPDX-License-Identifier: MIT",
        "This software is licensed under the MIT License; see the LICENSE file for details.",
        "MIT License. Copyright (c) the authors.",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "This code is released under the BSD license.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "Released under the GPL, version 2 or any later version.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-2.0-only",
        "Licensed under the GNU GPL v3.",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "You can redistribute this library under the terms of the GNU Lesser General Public License.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
        "Licensed under the GNU LGPL v3.",
    ),
    "AGPL": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "Licensed under the GNU AGPL v3.",
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
        "Licensed under the Mozilla Public License 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This library is distributed under the MPL 2.0.",
    ),
    "CC-BY": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "This article is distributed under the terms of the Creative Commons Attribution 4.0 International License, which permits unrestricted use, distribution, and reproduction in any medium, provided the original work is properly cited.",
        "SPDX-License-Identifier: CC-BY-4.0",
        "Published under a CC BY 4.0 licence.",
    ),
    "CC-BY-SA": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
        "Content on this site is licensed under a CC BY-SA 4.0 licence.",
    ),
    "CC-BY-NC": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
        "This article is available under the Creative Commons CC-BY-NC license and permits non-commercial use of the work as published.",
        "Published under a CC BY-NC 4.0 licence.",
    ),
    "CC0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Released under CC0 1.0 Universal, Public Domain Dedication.",
        "SPDX-License-Identifier: CC0-1.0",
        "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law.",
        "This dataset is dedicated to the public domain under CC0 1.0.",
    ),
    "proprietary": (
        "Copyright. All rights reserved. No part of this publication may be reproduced without the prior written permission of the publisher.",
        "All rights reserved.",
        "This software is proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly prohibited.",
        "No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher.",
        "Copyright (c) the company. All rights reserved.",
    ),
}
OTHER = (
    "He renewed the license of his car last week.",
    "A driving license is needed to rent a van.",
    "The public library opens at nine, and entry is free of charge.",
    "The general said that the version of the public was wrong.",
    "Students of MIT released a new study of the work.",
    "The Apache helicopter flew under the bridge.",
    "The law permits redistribution of land under some conditions.",
    "Copyright law is taught in the second year.",
    "The report was released under the terms of the agreement.",
    "The band released its first album under the name of the singer.",
    "The prisoners were released under the new law by the general.",
    "Permission was granted by the city to any person who lives there.",
    "The minister reserved all rights to speak at the public meeting.",
    "The new version of the work was published by the university.",
    "Free software meetings take place in the library every week.",
    "The fitness of the team was in no event the particular purpose.",
    "A copy of the book was furnished to all persons without restriction.",
    "The source of the river may not be used by the public.",
    "The commons were open to creative people of every town.",
    "The software company hired a person with prior written references.",
    "The domain of the function is public knowledge, and its terms apply.",
    "Redistribution of income is a matter of public policy.",
    "She works under license for a brewery in the north.",
    "The foundation published its terms and conditions on Monday.",
    "The following conditions led to the loss of the version.",
    "The warranty of the car is limited to two years.",
    "Die Lizenz wird mit dem Antrag bei der Behörde gestellt.",
    "La licence de pêche est valable pour une saison entière.",
)

# Names of licences in short notices, and identifiers of the SPDX list, by family.
NAMES = {
    "Apache-2.0": ("Apache License 2.0", "Apache 2.0", "Apache-2.0", "Apache License, Version 2.0"),
    "MIT": ("MIT", "MIT License", "Expat License"),
    "BSD": ("BSD", "BSD License", "BSD 3-Clause License", "BSD-3-Clause", "BSD 2-Clause License"),
    "GPL": ("GPL", "GPL v3", "GPL v2", "GPL-3.0", "GNU GPL", "GNU General Public License", "GNU General Public License v3"),
    "LGPL": ("LGPL", "LGPL v3", "LGPL v2.1", "LGPL-2.1", "GNU LGPL", "GNU Lesser General Public License", "GNU Lesser General Public License v3"),
    "AGPL": ("AGPL", "AGPL v3", "AGPL-3.0", "GNU AGPL", "GNU Affero General Public License", "GNU Affero General Public License v3"),
    "MPL": ("MPL", "MPL 2.0", "MPL-2.0", "Mozilla Public License", "Mozilla Public License 2.0"),
    "CC-BY": ("CC BY 4.0", "CC BY", "Creative Commons Attribution", "Creative Commons Attribution 4.0"),
    "CC-BY-SA": ("CC BY-SA 4.0", "CC BY-SA", "Creative Commons Attribution-ShareAlike", "Creative Commons Attribution-ShareAlike 4.0"),
    "CC-BY-NC": ("CC BY-NC 4.0", "CC BY-NC", "Creative Commons Attribution-NonCommercial", "Creative Commons Attribution-NonCommercial 4.0"),
    "CC0": ("CC0", "CC0 1.0"),
}
IDENTIFIERS = {
    "Apache-2.0": ("Apache-2.0",), "MIT": ("MIT", "MIT-0"), "BSD": ("BSD-2-Clause", "BSD-3-Clause", "0BSD"), "GPL": ("GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"),
    "LGPL": ("LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"), "AGPL": ("AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"), "MPL": ("MPL-1.1", "MPL-2.0"),
    "CC-BY": ("CC-BY-3.0", "CC-BY-4.0"), "CC-BY-SA": ("CC-BY-SA-3.0", "CC-BY-SA-4.0"), "CC-BY-NC": ("CC-BY-NC-3.0", "CC-BY-NC-4.0"), "CC0": ("CC0-1.0",),
}
#: Words that tell licences apart: a notice that has one of them is not confirmed by a text without it.
MARKS = ("mit", "expat", "apache", "bsd", "gpl", "gnu", "lgpl", "lesser", "agpl", "affero", "mpl", "mozilla", "cc", "by", "sa", "nc", "creative", "commons", "attribution", "sharealike", "noncommercial", "cc0")
#: Short notices, in which a name stands for {}.
WORDINGS = (
    "This package is licensed under the {}.", "This program is {} licensed.", "License: {}", "Distributed under the {}; see the LICENSE file.", "Released under the terms of the {}.", "The code is available under the {}.",
    "Licensed under {} or later.", "{} licensed.", "You may use this work under the {}.", "Source code is under the {} license.", "All files are covered by the {}.", "Published under {}.",
)
SHORT = {family: tuple(w.format(n) for w in WORDINGS for n in names) for family, names in NAMES.items()}
