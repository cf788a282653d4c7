"""Canonical digests of whole licence texts: digest, first letters, licence, sizes in paragraphs.

Made by `licences.known_digests` from the texts themselves, with and without what follows the terms.
"""

DIGESTS = (
    ("536268a29a0159e67af17c6e67180c66dd3d63b55f1de711e05c122be8002289", "apa", "Apache-2.0", [27]),
    ("94ab2db69513be8875470e3a4d39d5a437c91da93f172411d69d7552938f539a", "apa", "Apache-2.0", [33]),
    ("e31ac59f164ccf53aa974b50f93c9ea55654552a7beb0de32efa0ddda78b04a9", "apa", "Apache-2.0", [26]),
    ("08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702", "the", "Artistic-1.0", [29]),
    ("986c3c3199a93b916c8f2e0aeed57819bcbdcb2cd9d99902dcc9d74b53f93a74", "red", "BSD-2-Clause", [3]),
    ("21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651", "red", "BSD-3-Clause", [2]),
    ("9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2", "red", "BSD-3-Clause", [5]),
    ("96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f", "cre", "CC0-1.0", [13]),
    ("5379e6f33e826ba185b23fd11a414555c2161fda481478babd1e73a3ae098a71", "gnu", "GFDL-1.2", [57]),
    ("93d6108daecdddc5f284cf8f2512fb0d72f6e9ee12381feb9704ba194b00c3e6", "gnu", "GFDL-1.3", [67]),
    ("6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc", "gnu", "GPL-1.0", [32]),
    ("89f75ffda938e788be38679f9f83e317c2a03398fccf03ee60505d44d1bf9f70", "gnu", "GPL-1.0", [31]),
    ("8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224", "gnu", "GPL-1.0", [46]),
    ("6d332dc4c3c5293a73c6c9da402f9bbc970b3bb1eb472f577e00580573469808", "gnu", "GPL-2.0", [43]),
    ("e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34", "gnu", "GPL-2.0", [44]),
    ("efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821", "gnu", "GPL-2.0", [59]),
    ("092a7f3b82e6c22949b46388bca99e725b6e756f1c2b1e3f575447fbd44b6191", "gnu", "GPL-3.0", [108]),
    ("a8cd54d6683aa630f0b8d05d56184ad91dc486756da2df61c94d3e4e8d5ecb68", "gnu", "GPL-3.0", [122]),
    ("ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636", "gnu", "GPL-3.0", [109]),
    ("430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2", "gnu", "LGPL-2.0", [62]),
    ("504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260", "gnu", "LGPL-2.0", [63]),
    ("61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908", "gnu", "LGPL-2.0", [74]),
    ("48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4", "gnu", "LGPL-2.1", [65]),
    ("4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891", "gnu", "LGPL-2.1", [76]),
    ("bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df", "gnu", "LGPL-2.1", [64]),
    ("aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be", "gnu", "LGPL-3.0", [37]),
    ("1cfb6cca26abe2169c9c61164807107b2d4a0b64955a2cf2de46fad3483acda1", "moz", "MPL-1.1", [73]),
    ("3dacd2c104719e7227969cbdcc7d581518827199e830b9379627eec0a32f8ab7", "moz", "MPL-2.0", [81]),
    ("8d3909f4543649cfba0b0b1fc765c67acf3736106a78237ea2972f83eaa7dd3e", "thi", "Unlicense", [5]),
    ("1b8c5cd52eceb19ab0bc3cb40be110b1c0e7fa2671a3fe5866e59dd1502e69c7", "thi", "Zlib", [5]),
    ("99618428d879198d4ae824db7ad07a9d0f9214f15429de52839cbe667713f21a", "zli", "Zlib", [4]),
)
