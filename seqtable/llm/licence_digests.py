"""Digests of the canonical forms of full licences and their paragraphs, made by `licences.units` from the files distributed with them.

Fields: digest, licence, unit, parts, low, high.
"""

DIGESTS: list[tuple[str, str, str, int, int, int]] = [
    ("d33977dda82f80cb96313e370c5bf8ba496a39e48f6a6a861730aadf0ea5075a", "Apache-2.0", "text", 32, 9804, 9900),
    ("1fad080456cba08a2ac770d0e31c4bab208dcccafc33b5fb71dfe1e0e928d88c", "Apache-2.0", "part 0", 32, 60, 73),
    ("93e3687e4f6d3361c07028c5c841dbe962c782ad1f86d4a2bd009e050751dc7b", "Apache-2.0", "part 1", 32, 58, 58),
    ("5e8200d69042fa63eaa665929691dfcc31c9c429a69a9c5659fdb8c74ff25e15", "Apache-2.0", "part 2", 32, 13, 13),
    ("c413f6566eac09deabd7dd17fbf82e6f44b7a8c3ad65fff893cda28143eaf113", "Apache-2.0", "part 3", 32, 133, 135),
    ("f3f9045f0f0f2ef027291c9929835bf5203680f3eb86d5c0be9a7e1eae9e32db", "Apache-2.0", "part 4", 32, 112, 114),
    ("a6977de03549cc3eadb7953b9f93f4d4d14d0e4318ae5a3bc83c3d735ce759ad", "Apache-2.0", "part 5", 32, 432, 432),
    ("e763de90a530e9d38438df36422ae7c97e7fc230398fae521e54d5c2840964f7", "Apache-2.0", "part 6", 32, 99, 101),
    ("47299056c1de372c0948bcf8b1876e5e3cd4d18f054127be4e121e23175f5545", "Apache-2.0", "part 7", 32, 161, 161),
    ("e35324b03da62fb390c0ddb392a586e021d98e734e5c27f0ca086bfe37aa4863", "Apache-2.0", "part 8", 32, 215, 215),
    ("9232e8ee1be3c77443a31437cf83ddee0fad450f19f3c6cf35bc76ca8a172eea", "Apache-2.0", "part 9", 32, 228, 230),
    ("4f384465379f141148dd40eac0905ce2283d3f89252262fb85430bc15c6d422a", "Apache-2.0", "part 10", 32, 440, 442),
    ("547aec9dbe988725a4cece221762e99098ddde5743fc3f57f9672d3faaff7b55", "Apache-2.0", "part 11", 32, 864, 864),
    ("0a1c56a3563d82505bd2cfd57c89416ed3b026e34ad9f0ad2950a673d211e7df", "Apache-2.0", "part 12", 32, 175, 175),
    ("354108e897e1c228c8a8f40720a617c9c3e962d13c622eb8a61d526d09a75c81", "Apache-2.0", "part 13", 32, 368, 376),
    ("6ea6bf31b17081124b32ce5cf361f415a9dad94406e097185cadb472c3d7a47b", "Apache-2.0", "part 14", 32, 920, 932),
    ("b9536b1bb1f0c98d21b0be01436d2bd1e7bb1afb55a5843b3848b3c7ef3e09c5", "Apache-2.0", "part 15", 32, 217, 217),
    ("d2de18edc2f38c477928df228259bb8ed4cc9cf6950d1bde89be1281e6e0bd81", "Apache-2.0", "part 16", 32, 95, 97),
    ("21b8bd00368055c99e5135ab84dbe4fd8048879a8038bd7db7a96edf8b7f95ab", "Apache-2.0", "part 17", 32, 101, 101),
    ("5d09230c0c4a8effa82df658d3ed98a9898b4300f205086a221993833c808069", "Apache-2.0", "part 18", 32, 191, 191),
    ("c4ddcd6defb95e2ae3ae1b609ec8b017f2203efda6a4524b75ff438ae9fa5abd", "Apache-2.0", "part 19", 32, 929, 933),
    ("3f979f4e84fa3ba7d5471217f328634d260ce7b0d04aaf8d60273a9f20f23c05", "Apache-2.0", "part 20", 32, 356, 360),
    ("b6f8c70ae414c2b12d4f931b1a535c20f70c15e607538e347eee33d668b57093", "Apache-2.0", "part 21", 32, 432, 436),
    ("0fb2aaba4582f3a0b1624d72291f29e14fff2b3b4d085eb89e102cad1b6c26be", "Apache-2.0", "part 22", 32, 268, 270),
    ("cba549542a8ced7945d67edc026c26f67d45e82a7965c3c2b7a817e209b9e7b9", "Apache-2.0", "part 23", 32, 566, 568),
    ("268ef0e7c99876c159301a7339e8692e0f159603764d91daa6266de008c919e3", "Apache-2.0", "part 24", 32, 682, 684),
    ("56a893e2804985396346db1c6e1d8d0fe630553b6a83b70f42a5a10d53112d9a", "Apache-2.0", "part 25", 32, 628, 630),
    ("9f4a72c489c21471cc17ea0070937c5763a53121bbf0718a5749b8ef05435557", "Apache-2.0", "part 26", 32, 27, 27),
    ("57851aab583fee18de798cfae7339cd508c6e83e421c6d2a20eda23263c32dcc", "Apache-2.0", "part 27", 32, 53, 55),
    ("1a016522c548cfe68681f446c31c700f34446bdf18ba95fcc1543aef7a014b9f", "Apache-2.0", "part 28", 32, 459, 461),
    ("05369519785beeae50e8b52537bf3155eda6b7459224dbfc24e32a66bd6cc6cc", "Apache-2.0", "part 29", 32, 154, 171),
    ("a7e4f611f48214b5c7e85bcc2eeb0b2d805214e9b2b409990470c317c8b21036", "Apache-2.0", "part 30", 32, 39, 43),
    ("25e4a6e9184ac4b7f8272e658fb49b47495396a75fa532e1ed0ec24555ec98b6", "Apache-2.0", "part 31", 32, 298, 304),
    ("e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2", "Artistic-1.0-Perl", "text", 29, 5826, 5837),
    ("9fed8b0e06b2229a97a10906ed7a4e4608b849d85ed54da1ada55f2d05e8d9db", "Artistic-1.0-Perl", "part 0", 29, 20, 22),
    ("9a9b9a1c3f54a244a0f9fe66967769d25f166dcd6209e2c205ef50915e683bdc", "Artistic-1.0-Perl", "part 1", 29, 8, 8),
    ("0570358f9b20d0503bbcdba2c25a24f87b07958b2453053e5e0749b359045404", "Artistic-1.0-Perl", "part 2", 29, 368, 368),
    ("02f086eb77504748cf5130e6b17cc467b8b16d52b4f86c6237325033d4726294", "Artistic-1.0-Perl", "part 3", 29, 11, 11),
    ("249694a0b8a56d24885d3322b12ea7d61ff0bc736b87e270befc9a7df91b611a", "Artistic-1.0-Perl", "part 4", 29, 158, 158),
    ("26a5036b90c50f37bc8880e7c9933b79ff67a271fbf6902b8d41c99157e87078", "Artistic-1.0-Perl", "part 5", 29, 163, 163),
    ("5eae68f403641ae971d576974b3dbdd6fa70a017adfdf101ceb5bff158a864f5", "Artistic-1.0-Perl", "part 6", 29, 83, 83),
    ("935483456caf8461f64ec593942764fb3f7bb6ad61771c39d95355d0553c75ab", "Artistic-1.0-Perl", "part 7", 29, 72, 72),
    ("6b1881cf0c56033efc24e3ac18611f0161bc978db46516115fd2c57eda464883", "Artistic-1.0-Perl", "part 8", 29, 274, 274),
    ("f0972b40700cb959d9156ed21a588afde1560077cb92020ce7a290c852e74d2b", "Artistic-1.0-Perl", "part 9", 29, 225, 225),
    ("0c91fee77771917d70953c0c7ae021e6ef79ace44316779db84444a5a68ae984", "Artistic-1.0-Perl", "part 10", 29, 216, 216),
    ("cc41408ae87eb3cf3a3fa2ba3d84bc806616c64096a7ce4f79e61794483f6232", "Artistic-1.0-Perl", "part 11", 29, 207, 207),
    ("582b3c1d9c5b3e79b1e85ac3a61252db6de3c71541c32a14fd5da82936eebe03", "Artistic-1.0-Perl", "part 12", 29, 226, 226),
    ("1d49793201788f397b5a36a79d65422d741ab6216ff625218d577b90b08ec61f", "Artistic-1.0-Perl", "part 13", 29, 338, 338),
    ("0436fb927d3357b70bba24e62896a7ed5f4975d8466b895ca22ab9ef80425f6b", "Artistic-1.0-Perl", "part 14", 29, 71, 71),
    ("b5b1adc2af5a40205acbfc45305c0e1e3ed291f16630602f28a187aefdb4fb39", "Artistic-1.0-Perl", "part 15", 29, 252, 252),
    ("65a0d0e8ffba6ce692fb84fcc3fc39fbf206a3f8124146b0648a2ccf3973d0c6", "Artistic-1.0-Perl", "part 16", 29, 64, 64),
    ("ef4728095fa172fd083c6e17d3a9983ab2889abb174ac439eb44ffe8c607ec3f", "Artistic-1.0-Perl", "part 17", 29, 134, 134),
    ("1090ca30e4f915ac56c035c94a5d558bae6bcbaffdef40403462e37b6b1032bb", "Artistic-1.0-Perl", "part 18", 29, 165, 165),
    ("d12e38e2e59a5f692ab2f22b23cf9f0aebacdf9f6cae5b7a6d5565e503f32188", "Artistic-1.0-Perl", "part 19", 29, 100, 100),
    ("83b94dc94cd1c404db94084c1288adcfd2ba82c75756e52061381285a5819d6a", "Artistic-1.0-Perl", "part 20", 29, 181, 181),
    ("65a0d0e8ffba6ce692fb84fcc3fc39fbf206a3f8124146b0648a2ccf3973d0c6", "Artistic-1.0-Perl", "part 21", 29, 64, 64),
    ("cea9256897c4d377c32da8893506f8e0dd548cb00972f31c1212006bce104444", "Artistic-1.0-Perl", "part 22", 29, 631, 631),
    ("9c1db0e3aefd5f6f4c3def481dbd25d5582dae24248299993a53df4b3daab3d6", "Artistic-1.0-Perl", "part 23", 29, 681, 681),
    ("cbc8ba0d7705ff60d4174b264875b33660428b42509a420d2743e0a44ba06744", "Artistic-1.0-Perl", "part 24", 29, 426, 426),
    ("00e575f715b4a22c0cbb4ccf69efb3684d9ca467d4d559428742315b09e3eed0", "Artistic-1.0-Perl", "part 25", 29, 323, 323),
    ("4f85cbbd7a5ceb2a9b83a2b6ff1affb855ce45ad2e454e0f128a37ed76c1797e", "Artistic-1.0-Perl", "part 26", 29, 150, 150),
    ("87118e56b15cdee9225bf55ddf517bc49a2685028ce0a549518059b9c9ae83d2", "Artistic-1.0-Perl", "part 27", 29, 187, 187),
    ("92eb9cd081f0ec170823692b9af05567b358b15dc1be2bcf6130b6dc7cedcc28", "Artistic-1.0-Perl", "part 28", 29, 7, 7),
    ("957c3854a3d72e069e7f5e48857ad9ab76135f14c70d60fa9ec6ef9a928d45dd", "BSD-2-Clause", "text", 5, 1213, 1213),
    ("986c3c3199a93b916c8f2e0aeed57819bcbdcb2cd9d99902dcc9d74b53f93a74", "BSD-2-Clause", "text", 4, 1193, 1193),
    ("a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30", "BSD-2-Clause", "text", 4, 1197, 1197),
    ("eda2ad636e738f6a26a2fea902bb734ee48c789a5b40035b8db3659bd951e5bc", "BSD-2-Clause", "text", 5, 1217, 1217),
    ("2dbf9640a42c64e0012c55205e2158a6d895645a1f6934972c619f70b637cf4d", "BSD-2-Clause", "part 0", 5, 19, 19),
    ("48ac8ca1db37804517afc5e6eb5afcfc70793472047f88dd30d536751bc2c369", "BSD-2-Clause", "part 0", 4, 139, 139),
    ("05a8cf32673bea2565137831121d0865d922256b8a4e95abe9491f6196641a39", "BSD-2-Clause", "part 1", 4, 124, 124),
    ("48ac8ca1db37804517afc5e6eb5afcfc70793472047f88dd30d536751bc2c369", "BSD-2-Clause", "part 1", 5, 139, 139),
    ("7c1baf39c016fe0fc0574574656718d54f50821e2146a89de2565a1c1935d055", "BSD-2-Clause", "part 1", 4, 122, 122),
    ("05a8cf32673bea2565137831121d0865d922256b8a4e95abe9491f6196641a39", "BSD-2-Clause", "part 2", 5, 124, 124),
    ("34ab2952b7b5e2216c1dfcf9194c817e5fd97567ebf714b3893d63e55c5c590f", "BSD-2-Clause", "part 2", 4, 202, 202),
    ("7c1baf39c016fe0fc0574574656718d54f50821e2146a89de2565a1c1935d055", "BSD-2-Clause", "part 2", 5, 122, 122),
    ("ddc1b876bb8a74f62a81173c60857a327f7ca7bca00fede89aeea027a9dbcae1", "BSD-2-Clause", "part 2", 4, 200, 200),
    ("34ab2952b7b5e2216c1dfcf9194c817e5fd97567ebf714b3893d63e55c5c590f", "BSD-2-Clause", "part 3", 5, 202, 202),
    ("8840ecd4fe6d52fdb399755e5b2ab74adf3894ea580bf9360205303afcde5e53", "BSD-2-Clause", "part 3", 4, 729, 729),
    ("ddc1b876bb8a74f62a81173c60857a327f7ca7bca00fede89aeea027a9dbcae1", "BSD-2-Clause", "part 3", 5, 200, 200),
    ("8840ecd4fe6d52fdb399755e5b2ab74adf3894ea580bf9360205303afcde5e53", "BSD-2-Clause", "part 4", 5, 729, 729),
    ("007fde9b266f35183b511c8c01994581175bfdaa48438967e905c31fb50ba523", "BSD-3-Clause", "text", 6, 1400, 1400),
    ("53075742228962c7ea381b8242c64602fa32e7b8f52facb6d13ee4f9c596ddfa", "BSD-3-Clause", "text", 5, 1380, 1380),
    ("9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2", "BSD-3-Clause", "text", 5, 1386, 1386),
    ("eabe215ff5a2cf5b1c090915b7cabdf511f70fc79fb8fde85247ebe3038a9658", "BSD-3-Clause", "text", 6, 1406, 1406),
    ("2dbf9640a42c64e0012c55205e2158a6d895645a1f6934972c619f70b637cf4d", "BSD-3-Clause", "part 0", 6, 19, 19),
    ("48ac8ca1db37804517afc5e6eb5afcfc70793472047f88dd30d536751bc2c369", "BSD-3-Clause", "part 0", 5, 139, 139),
    ("05a8cf32673bea2565137831121d0865d922256b8a4e95abe9491f6196641a39", "BSD-3-Clause", "part 1", 5, 124, 124),
    ("48ac8ca1db37804517afc5e6eb5afcfc70793472047f88dd30d536751bc2c369", "BSD-3-Clause", "part 1", 6, 139, 139),
    ("7c1baf39c016fe0fc0574574656718d54f50821e2146a89de2565a1c1935d055", "BSD-3-Clause", "part 1", 5, 122, 122),
    ("05a8cf32673bea2565137831121d0865d922256b8a4e95abe9491f6196641a39", "BSD-3-Clause", "part 2", 6, 124, 124),
    ("34ab2952b7b5e2216c1dfcf9194c817e5fd97567ebf714b3893d63e55c5c590f", "BSD-3-Clause", "part 2", 5, 202, 202),
    ("7c1baf39c016fe0fc0574574656718d54f50821e2146a89de2565a1c1935d055", "BSD-3-Clause", "part 2", 6, 122, 122),
    ("ddc1b876bb8a74f62a81173c60857a327f7ca7bca00fede89aeea027a9dbcae1", "BSD-3-Clause", "part 2", 5, 200, 200),
    ("02cadc7ac61e871f2b2fec80c2c7a8fc276ea60398514318df06e36c7a9a6a88", "BSD-3-Clause", "part 3", 5, 188, 188),
    ("18494a354dce770d0da116b1db4d37fd6cd1306e5b20210db067f2bb4267c389", "BSD-3-Clause", "part 3", 5, 186, 186),
    ("34ab2952b7b5e2216c1dfcf9194c817e5fd97567ebf714b3893d63e55c5c590f", "BSD-3-Clause", "part 3", 6, 202, 202),
    ("ddc1b876bb8a74f62a81173c60857a327f7ca7bca00fede89aeea027a9dbcae1", "BSD-3-Clause", "part 3", 6, 200, 200),
    ("02cadc7ac61e871f2b2fec80c2c7a8fc276ea60398514318df06e36c7a9a6a88", "BSD-3-Clause", "part 4", 6, 188, 188),
    ("18494a354dce770d0da116b1db4d37fd6cd1306e5b20210db067f2bb4267c389", "BSD-3-Clause", "part 4", 6, 186, 186),
    ("8840ecd4fe6d52fdb399755e5b2ab74adf3894ea580bf9360205303afcde5e53", "BSD-3-Clause", "part 4", 5, 729, 729),
    ("8840ecd4fe6d52fdb399755e5b2ab74adf3894ea580bf9360205303afcde5e53", "BSD-3-Clause", "part 5", 6, 729, 729),
    ("96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f", "CC0-1.0", "text", 13, 6692, 6704),
    ("021f3f319970fcf1f6e1d478e5367d797699877f3434ad73ee1ef815fdc7cd63", "CC0-1.0", "part 0", 13, 27, 27),
    ("2aecef2d9b7eed9f3b36b6692ea7482f6577d85e59fd51dea4aa8edaa7282edd", "CC0-1.0", "part 1", 13, 17, 17),
    ("6306d25106a15ca126a9ad006950f3c3aaf90c8229437bfc7acb791aa3ae2c87", "CC0-1.0", "part 2", 13, 463, 463),
    ("258bc2759ea2cb9a64d69f2d91c7d8e4f1a88d1688b894fe7485b5d5c701ec58", "CC0-1.0", "part 3", 13, 20, 20),
    ("24279893481296e429db9bc0f5aa3d2339beefe5552e73b54261614894ab4d86", "CC0-1.0", "part 4", 13, 251, 251),
    ("025b47838add4cda9c8fd0c028a30441bdd11623782c25fb86e12c1d19c8d043", "CC0-1.0", "part 5", 13, 682, 682),
    ("a30e11290a86a38b2d5aebffbf46b096b10e279b86152eaad0ee0388a4cfce61", "CC0-1.0", "part 6", 13, 484, 484),
    ("8adae8faa63004b20c54ba7e618f3926241946f209459aaba22619fdb3e71a1a", "CC0-1.0", "part 7", 13, 229, 229),
    ("7bb1f351459665661202f312854eff12b5964c639081cb063a45db4fcd892af5", "CC0-1.0", "part 8", 13, 879, 879),
    ("79957adc11167b72198663bab50d00fceb7c56c33905cdc5066f2c0a6ce9df21", "CC0-1.0", "part 9", 13, 1098, 1098),
    ("4b66fb51100879ed9a82640e9bdaa244ea17509a3d66f8a6f50c54e575dab133", "CC0-1.0", "part 10", 13, 1425, 1437),
    ("b7e3dda976778c49eb8ec309249f763dcf441a5c6950d0cb5071e898fa64c055", "CC0-1.0", "part 11", 13, 29, 29),
    ("4ed62e34c78f973f9d6d5671c56910faa5a6032defec5f08726f85473ff0993a", "CC0-1.0", "part 12", 13, 1076, 1076),
    ("b74e613b97478ca0f7f30fc4b5b8861507027e89e90e2b327412ca7a1ec39494", "GFDL-1.2", "text", 57, 19582, 19720),
    ("8d2eae4d251844e9a73f0504efb40de0122c63022a833e6e0f5caafcd8f04324", "GFDL-1.2", "part 0", 57, 56, 58),
    ("d093a38219ee3a62fe302fb63439ff75a2ca95cbb906cf96a4bd33341df9b267", "GFDL-1.2", "part 1", 57, 168, 170),
    ("d5dd271421fb47626550b2490cff8c3bcf7b543096db366f8b90a23d49a230e7", "GFDL-1.2", "part 2", 57, 10, 10),
    ("ffd9cbb86b506d4eaf39671a3ed1916dfa5c78395118648bc8fff9c317622776", "GFDL-1.2", "part 3", 57, 433, 437),
    ("7235eb1fa53d96ab2e2bc3826a791715fc300317887fbdb81865b2e5e9ab3de0", "GFDL-1.2", "part 4", 57, 227, 233),
    ("edac903f23b3d0b3518599eb5d1c1cb212c760f3e773fc67e7088486eaf2cbb8", "GFDL-1.2", "part 5", 57, 468, 474),
    ("4a82b7db0c80378824dc5104fc104cfd1bcab98da53157518ce6459870b38ea1", "GFDL-1.2", "part 6", 57, 31, 31),
    ("58f56917d10a4e256a0646fcd6950bf4725415978b5d8e1370de7152d87866f9", "GFDL-1.2", "part 7", 57, 537, 545),
    ("239670a0259b716f258b4924b7af150d9c7ba50dcb10dd0bb456c7805a6a14d5", "GFDL-1.2", "part 8", 57, 177, 177),
    ("6624bef9fb98ef780836b1db171a161889e037fa755daf13107cd0b4a55a2876", "GFDL-1.2", "part 9", 57, 594, 594),
    ("5fa0dda07cb5184cf6a9100d492cb5d2cb9f04065ba24f3f594a73e0c255a6aa", "GFDL-1.2", "part 10", 57, 430, 432),
    ("cbc68a20fa863fbf9443143b1f4ae910f95fdecca8699aaba9599806f46696c2", "GFDL-1.2", "part 11", 57, 268, 270),
    ("e4a1e57f9f435965b9a55654cfe44e125b3c9e005632753d3534b44f0f4a206c", "GFDL-1.2", "part 12", 57, 788, 788),
    ("967dc89b2ca094fa7064c23256ff50f8a129182610bd8a11e90e2808eb80c35d", "GFDL-1.2", "part 13", 57, 613, 613),
    ("7dc48d09082c73e46bc0c56d4596a989b8b741d322e57087251484277b2d690a", "GFDL-1.2", "part 14", 57, 371, 373),
    ("db6eb9a432fd54ed050cb271fec4a0879a2edc1fd610ee922aeeaf95a55929fa", "GFDL-1.2", "part 15", 57, 446, 446),
    ("70b167b78b2b831bbfbf509341d2b4644142ade9baf9262a5c60411dad8cb836", "GFDL-1.2", "part 16", 57, 368, 374),
    ("1e404ed2fd3ad96d2b7120de85fb631cb802220057214629aef1830251db7a3b", "GFDL-1.2", "part 17", 57, 18, 18),
    ("5a40bb13d15da31b207b9c286de2e77c57afd8b3eb05d9ee1ed483ec57aa2d0c", "GFDL-1.2", "part 18", 57, 595, 603),
    ("00cc1e2bd0b26b1286ebedeb47865be95ea4135f0d6fb39597334f6a4f4123e6", "GFDL-1.2", "part 19", 57, 99, 99),
    ("f37f33b63bd948d1531389fe60306922169a5d5cd0336a2b949ef2b28d1f1644", "GFDL-1.2", "part 20", 57, 21, 21),
    ("e305540b82dc9c79a55d984d80b901ffac60539c8e68643ed5cdc96b74448971", "GFDL-1.2", "part 21", 57, 763, 765),
    ("31b4d47ff2fe9e0cf056eacbafc87e4c84a57236cd4686f295ec637f31bfb567", "GFDL-1.2", "part 22", 57, 197, 197),
    ("8348e7c372ee0b6e2dc40f98a56299c5d43c219ee756a0947b17a3f350bb85fb", "GFDL-1.2", "part 23", 57, 771, 771),
    ("bd225944db54f562f7691e839b50014e5fd6dafbf9d5a7bc7fd22c6e1a1b4c84", "GFDL-1.2", "part 24", 57, 208, 208),
    ("d7b0855a4af23bab8d44bc833ffadd66cffa1b01f379b1e21aa5f6d660d2ad50", "GFDL-1.2", "part 25", 57, 15, 15),
    ("aa5b684158f44eac27ded9316d0b96d9882e1e8d803a97b8298254bb2c79fa11", "GFDL-1.2", "part 26", 57, 408, 410),
    ("6706780d5092660e7a619a1ebf9ffac30ad01c77e1df10e494e6fa8b8de81de9", "GFDL-1.2", "part 27", 57, 2772, 2782),
    ("9904d6725b29e567220643410be424837341f61915acc24fad80131bb017a58c", "GFDL-1.2", "part 28", 57, 395, 397),
    ("0fa0e2cb0c6950d08cebf64249e44fc19fb3d970c7886574accc151c56767d4c", "GFDL-1.2", "part 29", 57, 271, 271),
    ("b48a77bf944b0aaa311c9459ced8b5ed0e71e93c6863d3f8db46988ee0343140", "GFDL-1.2", "part 30", 57, 594, 594),
    ("737156634ce6acd54b47100c3106aafe929040e4887b46155d93b84959061d8d", "GFDL-1.2", "part 31", 57, 178, 180),
    ("f3b4b9f1ad6deec2ed4a8c93337b11658f94c115046d06f1e731b7e6653c70fa", "GFDL-1.2", "part 32", 57, 21, 21),
    ("3c77bf4976824ca6eb0ea5b05f3cff79aa74ba778302393354a189db5e40f99d", "GFDL-1.2", "part 33", 57, 398, 402),
    ("d60dc25808aeea040f50ad0bbdb482cbaaf2efaaa225586787abc1ddb39ae4ec", "GFDL-1.2", "part 34", 57, 523, 527),
    ("976618724355880ea41bb152ca264f595dd75f4c333553199314690173ab8328", "GFDL-1.2", "part 35", 57, 281, 281),
    ("0cbbd960f685cc48e5e093457ed8d458f4f214466044c6de4c9eb85d0290a93b", "GFDL-1.2", "part 36", 57, 26, 26),
    ("1fb18fdc326175dbbc0cbd7b3691d15f53491f293c068063bb1cac47d5e3c089", "GFDL-1.2", "part 37", 57, 348, 354),
    ("fd2655b934552b93a1ba5fd6d90b849e5d69daef4bc63ae41381a67e3801a854", "GFDL-1.2", "part 38", 57, 267, 273),
    ("aa8976ff6775fc655b3a42397eb76184ac99b6c9b52ee3c4c86f737210cd0ab5", "GFDL-1.2", "part 39", 57, 36, 36),
    ("24d6e1842e3832c2435e763e134dc70116cae6534784941dd006d848738298fb", "GFDL-1.2", "part 40", 57, 501, 503),
    ("8066fbfc0c2250e93bf9da2c92d67a6e16d9963cc7518946ba51c03e70957b63", "GFDL-1.2", "part 41", 57, 408, 408),
    ("0b81cb06867df6f75207433e8ad6794c02a14e422175ab23b15697981b3ce80e", "GFDL-1.2", "part 42", 57, 13, 13),
    ("9d86589040c61bed27024f44402b3fe0da3138c8f0952d1c01a331b385400db5", "GFDL-1.2", "part 43", 57, 769, 777),
    ("60f7c0363c8a6ab4d5eaa11f6c154d9b9460ad8e15f5496e4cb011fca3accad1", "GFDL-1.2", "part 44", 57, 187, 187),
    ("5e3ba6934ac9c18789b6335974896c9fda5dd5f7984f22086113bb264d6c0435", "GFDL-1.2", "part 45", 57, 13, 13),
    ("96d7c5afe1148112c1205466d9d5987d8feb4e7d761fd8848b03029ba4fd1f08", "GFDL-1.2", "part 46", 57, 424, 436),
    ("0727f47bb2ef0ba94fc2e548e26b9a3069479758f55960c0777f554dfbd338f1", "GFDL-1.2", "part 47", 57, 35, 37),
    ("d97a13d8315dec356f8f11a8c2b1ec7bdac1cea9e075224f9cceccdba252bb68", "GFDL-1.2", "part 48", 57, 275, 279),
    ("86c5d5251aff2698dc183298c43116db2cdace0b472e8e96c1c9dbe444e53f2b", "GFDL-1.2", "part 49", 57, 521, 527),
    ("8fdbf25ee440a6f48b6904fb9945d3c154bc1bdc212b6cdbf8a0204591e6bde0", "GFDL-1.2", "part 50", 57, 51, 53),
    ("6fc07465c398129200dc382361153dd460dbe4de29396b250cbd7dbb2a1e191b", "GFDL-1.2", "part 51", 57, 174, 180),
    ("b2676b371a3c66233a13c161e9279791ddbbb40940a9bfe4b212f1fb7acc59d2", "GFDL-1.2", "part 52", 57, 358, 364),
    ("c746f66f38ddbac28c81c5f45e0bca5a732716dfc772d3f2b2abdd0e2c50f5e9", "GFDL-1.2", "part 53", 57, 107, 107),
    ("967fa6e4b38f0fa30651100146851ad69c6648c96df83c192bda664969141d7d", "GFDL-1.2", "part 54", 57, 130, 130),
    ("aa518b451569f5c907538bceffb83ffea839c5d7569c456103960cd0d2385019", "GFDL-1.2", "part 55", 57, 140, 140),
    ("22036bf8d3f282ab5a8a166fa766b93be638e78efa9b4e851bfea7d74945e956", "GFDL-1.2", "part 56", 57, 230, 234),
    ("ea05ef7a0bb68d576ca10190291850f3f6e8afc6f69011030606c6b91fde46b6", "GFDL-1.3", "text", 67, 22018, 22176),
    ("f42b2e6807623175c74cf8ca228746283c01775b536214b79d00df84c9a65ffa", "GFDL-1.3", "part 0", 67, 58, 60),
    ("a68db0e4a857e92e92026b5768fdefffb5e1958a892d0d2c250d935fe91141de", "GFDL-1.3", "part 1", 67, 130, 132),
    ("d5dd271421fb47626550b2490cff8c3bcf7b543096db366f8b90a23d49a230e7", "GFDL-1.3", "part 2", 67, 10, 10),
    ("ffd9cbb86b506d4eaf39671a3ed1916dfa5c78395118648bc8fff9c317622776", "GFDL-1.3", "part 3", 67, 433, 437),
    ("7235eb1fa53d96ab2e2bc3826a791715fc300317887fbdb81865b2e5e9ab3de0", "GFDL-1.3", "part 4", 67, 227, 233),
    ("edac903f23b3d0b3518599eb5d1c1cb212c760f3e773fc67e7088486eaf2cbb8", "GFDL-1.3", "part 5", 67, 468, 474),
    ("4a82b7db0c80378824dc5104fc104cfd1bcab98da53157518ce6459870b38ea1", "GFDL-1.3", "part 6", 67, 31, 31),
    ("58f56917d10a4e256a0646fcd6950bf4725415978b5d8e1370de7152d87866f9", "GFDL-1.3", "part 7", 67, 537, 545),
    ("239670a0259b716f258b4924b7af150d9c7ba50dcb10dd0bb456c7805a6a14d5", "GFDL-1.3", "part 8", 67, 177, 177),
    ("6624bef9fb98ef780836b1db171a161889e037fa755daf13107cd0b4a55a2876", "GFDL-1.3", "part 9", 67, 594, 594),
    ("5fa0dda07cb5184cf6a9100d492cb5d2cb9f04065ba24f3f594a73e0c255a6aa", "GFDL-1.3", "part 10", 67, 430, 432),
    ("cbc68a20fa863fbf9443143b1f4ae910f95fdecca8699aaba9599806f46696c2", "GFDL-1.3", "part 11", 67, 268, 270),
    ("e4a1e57f9f435965b9a55654cfe44e125b3c9e005632753d3534b44f0f4a206c", "GFDL-1.3", "part 12", 67, 788, 788),
    ("967dc89b2ca094fa7064c23256ff50f8a129182610bd8a11e90e2808eb80c35d", "GFDL-1.3", "part 13", 67, 613, 613),
    ("7dc48d09082c73e46bc0c56d4596a989b8b741d322e57087251484277b2d690a", "GFDL-1.3", "part 14", 67, 371, 373),
    ("24f308654a4530485716218bbce0db461ad3aea4f1bcb7a52df89bf3525dc70e", "GFDL-1.3", "part 15", 67, 94, 94),
    ("db6eb9a432fd54ed050cb271fec4a0879a2edc1fd610ee922aeeaf95a55929fa", "GFDL-1.3", "part 16", 67, 446, 446),
    ("70b167b78b2b831bbfbf509341d2b4644142ade9baf9262a5c60411dad8cb836", "GFDL-1.3", "part 17", 67, 368, 374),
    ("1e404ed2fd3ad96d2b7120de85fb631cb802220057214629aef1830251db7a3b", "GFDL-1.3", "part 18", 67, 18, 18),
    ("5a40bb13d15da31b207b9c286de2e77c57afd8b3eb05d9ee1ed483ec57aa2d0c", "GFDL-1.3", "part 19", 67, 595, 603),
    ("00cc1e2bd0b26b1286ebedeb47865be95ea4135f0d6fb39597334f6a4f4123e6", "GFDL-1.3", "part 20", 67, 99, 99),
    ("f37f33b63bd948d1531389fe60306922169a5d5cd0336a2b949ef2b28d1f1644", "GFDL-1.3", "part 21", 67, 21, 21),
    ("e305540b82dc9c79a55d984d80b901ffac60539c8e68643ed5cdc96b74448971", "GFDL-1.3", "part 22", 67, 763, 765),
    ("31b4d47ff2fe9e0cf056eacbafc87e4c84a57236cd4686f295ec637f31bfb567", "GFDL-1.3", "part 23", 67, 197, 197),
    ("8348e7c372ee0b6e2dc40f98a56299c5d43c219ee756a0947b17a3f350bb85fb", "GFDL-1.3", "part 24", 67, 771, 771),
    ("bd225944db54f562f7691e839b50014e5fd6dafbf9d5a7bc7fd22c6e1a1b4c84", "GFDL-1.3", "part 25", 67, 208, 208),
    ("d7b0855a4af23bab8d44bc833ffadd66cffa1b01f379b1e21aa5f6d660d2ad50", "GFDL-1.3", "part 26", 67, 15, 15),
    ("aa5b684158f44eac27ded9316d0b96d9882e1e8d803a97b8298254bb2c79fa11", "GFDL-1.3", "part 27", 67, 408, 410),
    ("6706780d5092660e7a619a1ebf9ffac30ad01c77e1df10e494e6fa8b8de81de9", "GFDL-1.3", "part 28", 67, 2772, 2782),
    ("9904d6725b29e567220643410be424837341f61915acc24fad80131bb017a58c", "GFDL-1.3", "part 29", 67, 395, 397),
    ("0fa0e2cb0c6950d08cebf64249e44fc19fb3d970c7886574accc151c56767d4c", "GFDL-1.3", "part 30", 67, 271, 271),
    ("b48a77bf944b0aaa311c9459ced8b5ed0e71e93c6863d3f8db46988ee0343140", "GFDL-1.3", "part 31", 67, 594, 594),
    ("737156634ce6acd54b47100c3106aafe929040e4887b46155d93b84959061d8d", "GFDL-1.3", "part 32", 67, 178, 180),
    ("f3b4b9f1ad6deec2ed4a8c93337b11658f94c115046d06f1e731b7e6653c70fa", "GFDL-1.3", "part 33", 67, 21, 21),
    ("3c77bf4976824ca6eb0ea5b05f3cff79aa74ba778302393354a189db5e40f99d", "GFDL-1.3", "part 34", 67, 398, 402),
    ("d60dc25808aeea040f50ad0bbdb482cbaaf2efaaa225586787abc1ddb39ae4ec", "GFDL-1.3", "part 35", 67, 523, 527),
    ("976618724355880ea41bb152ca264f595dd75f4c333553199314690173ab8328", "GFDL-1.3", "part 36", 67, 281, 281),
    ("0cbbd960f685cc48e5e093457ed8d458f4f214466044c6de4c9eb85d0290a93b", "GFDL-1.3", "part 37", 67, 26, 26),
    ("1fb18fdc326175dbbc0cbd7b3691d15f53491f293c068063bb1cac47d5e3c089", "GFDL-1.3", "part 38", 67, 348, 354),
    ("fd2655b934552b93a1ba5fd6d90b849e5d69daef4bc63ae41381a67e3801a854", "GFDL-1.3", "part 39", 67, 267, 273),
    ("aa8976ff6775fc655b3a42397eb76184ac99b6c9b52ee3c4c86f737210cd0ab5", "GFDL-1.3", "part 40", 67, 36, 36),
    ("24d6e1842e3832c2435e763e134dc70116cae6534784941dd006d848738298fb", "GFDL-1.3", "part 41", 67, 501, 503),
    ("8066fbfc0c2250e93bf9da2c92d67a6e16d9963cc7518946ba51c03e70957b63", "GFDL-1.3", "part 42", 67, 408, 408),
    ("0b81cb06867df6f75207433e8ad6794c02a14e422175ab23b15697981b3ce80e", "GFDL-1.3", "part 43", 67, 13, 13),
    ("9d86589040c61bed27024f44402b3fe0da3138c8f0952d1c01a331b385400db5", "GFDL-1.3", "part 44", 67, 769, 777),
    ("60f7c0363c8a6ab4d5eaa11f6c154d9b9460ad8e15f5496e4cb011fca3accad1", "GFDL-1.3", "part 45", 67, 187, 187),
    ("5e3ba6934ac9c18789b6335974896c9fda5dd5f7984f22086113bb264d6c0435", "GFDL-1.3", "part 46", 67, 13, 13),
    ("74eb38dcc2fd424f33041e63f8e6198243045f4dc55b65455f7f74033e81a8cc", "GFDL-1.3", "part 47", 67, 246, 254),
    ("e9809a959d6872db36eca125fc35dde5086eeafd9a19ffdc28e22bdecf922205", "GFDL-1.3", "part 48", 67, 359, 365),
    ("26d763024919e0b5e44b5f00fc11aede6a854c4d3b20b8010b5f50d5d56467b9", "GFDL-1.3", "part 49", 67, 355, 359),
    ("b431cce8555e68267cfab98477348bc40e07dcd98ec12e63b908339726bc2ebc", "GFDL-1.3", "part 50", 67, 310, 314),
    ("0727f47bb2ef0ba94fc2e548e26b9a3069479758f55960c0777f554dfbd338f1", "GFDL-1.3", "part 51", 67, 35, 37),
    ("d97a13d8315dec356f8f11a8c2b1ec7bdac1cea9e075224f9cceccdba252bb68", "GFDL-1.3", "part 52", 67, 275, 279),
    ("e2e54aec5f73259da9813dbd149450ecea80593073fcb57f918c2a8d1e5138fc", "GFDL-1.3", "part 53", 67, 745, 753),
    ("b5d1f416ebbcb311a6dd788aeea8e3eb8250a8195f194f579c9c903a55f10136", "GFDL-1.3", "part 54", 67, 14, 14),
    ("4d1357dd6aa8c413532383bfd764530df28cab5118ef2eab946048be941540e2", "GFDL-1.3", "part 55", 67, 388, 388),
    ("beeb7b93c5a18115a92a3dd5d5db78c2324359b14d4cdc71b2e84711fd396cde", "GFDL-1.3", "part 56", 67, 293, 297),
    ("184a06ef656852f2daf2eab2f3546c20fa37a84af2f78e3c415efaf7104ff7ca", "GFDL-1.3", "part 57", 67, 100, 100),
    ("506041ca9ad197f01996cc297c7822b36554b383916e4ffe3380c0daee676e73", "GFDL-1.3", "part 58", 67, 323, 327),
    ("eb58cb6f044c60d90e782e735c588b22a5102178059e8ee0c98b6bc2ac2527aa", "GFDL-1.3", "part 59", 67, 180, 180),
    ("8fdbf25ee440a6f48b6904fb9945d3c154bc1bdc212b6cdbf8a0204591e6bde0", "GFDL-1.3", "part 60", 67, 51, 53),
    ("6fc07465c398129200dc382361153dd460dbe4de29396b250cbd7dbb2a1e191b", "GFDL-1.3", "part 61", 67, 174, 180),
    ("2f621a218a1d890d14451649e7c17d7c39dc0ca94465d61bf5eb9d954b08445b", "GFDL-1.3", "part 62", 67, 358, 364),
    ("c746f66f38ddbac28c81c5f45e0bca5a732716dfc772d3f2b2abdd0e2c50f5e9", "GFDL-1.3", "part 63", 67, 107, 107),
    ("967fa6e4b38f0fa30651100146851ad69c6648c96df83c192bda664969141d7d", "GFDL-1.3", "part 64", 67, 130, 130),
    ("aa518b451569f5c907538bceffb83ffea839c5d7569c456103960cd0d2385019", "GFDL-1.3", "part 65", 67, 140, 140),
    ("22036bf8d3f282ab5a8a166fa766b93be638e78efa9b4e851bfea7d74945e956", "GFDL-1.3", "part 66", 67, 230, 234),
    ("4a30412e3dfe074a9b9d1065202be89812fc727145e77a2f13915adfee591e58", "GPL-1.0", "text", 50, 11764, 11824),
    ("82397a16c2231c372bdd0ef728bd88bf794e7b7858a5ee5e95a390556acb8081", "GPL-1.0", "part 0", 50, 50, 52),
    ("856c42764e52056205cc38c0f1803f6d6015fcc297dc33dcd2a99023b327adc3", "GPL-1.0", "part 1", 50, 51, 51),
    ("aaf9385eedc0e8797f25532c8f623c05bba02ebe7b124aefa1352367290a485a", "GPL-1.0", "part 2", 50, 116, 118),
    ("9a9b9a1c3f54a244a0f9fe66967769d25f166dcd6209e2c205ef50915e683bdc", "GPL-1.0", "part 3", 50, 8, 8),
    ("47c0c82313f5cb7fe16a46542a744a4003568f8d82578eecbf540beb8538db48", "GPL-1.0", "part 4", 50, 435, 441),
    ("db886688a80548c4babf01d4ba9879a258631dc65edf3fe72485732598874d91", "GPL-1.0", "part 5", 50, 378, 380),
    ("7ea3490cd136e23f34f4e5bc2d9148016b5c28de6067f6295412eeb3426d2198", "GPL-1.0", "part 6", 50, 259, 259),
    ("3722cc84c57c8b17f00c4f44db3830d77b4a780fb69a7638b5405927b33f90f4", "GPL-1.0", "part 7", 50, 246, 246),
    ("18442fdb3a23bbb1a6623619cb6ee2d71ec47f05f1d4de10db4812d23a94dc0d", "GPL-1.0", "part 8", 50, 170, 172),
    ("fd67f194410e043215cd5a4a333c7554828a31185aec0418c19882838fe48d56", "GPL-1.0", "part 9", 50, 365, 365),
    ("b56a5e74095a5a82fe5abfc423bf152c935bb7105a5897be9f3faceaeb9ede35", "GPL-1.0", "part 10", 50, 81, 81),
    ("babf4896388ec979a002db2fbc0d24076cecd03256f32b99565bcb76eab5e41c", "GPL-1.0", "part 11", 50, 89, 91),
    ("4b3a2f51074477b0a310410bf82471921b1c2c36b2075a6a494cc2656a525afa", "GPL-1.0", "part 12", 50, 428, 432),
    ("0ce51885233fe93bd7a178ef07cc5c5c5d2c67a73959e6ab929fb4c836965975", "GPL-1.0", "part 13", 50, 512, 516),
    ("b304eb4eccc2a9bff6cbe38980f979ceed9513e50fc22f8482aec81c3763735c", "GPL-1.0", "part 14", 50, 192, 192),
    ("55671c01e5247c9861eb7881d42d41ddf720dd18452cef68a3209f9f67de083b", "GPL-1.0", "part 15", 50, 119, 119),
    ("7b73ffd7af740201afcd1497317cb75a9885c87c99f3903d5d3f25ef5b9a9f8c", "GPL-1.0", "part 16", 50, 359, 361),
    ("144d18d8c9114c3dd9a68912281b5a58590181f5ec991532cd1689d387b2ff33", "GPL-1.0", "part 17", 50, 469, 471),
    ("d6e670864a87d967339b9a0dbfe3123c21a84c705d4835e0feaa6f1e46d2e6f0", "GPL-1.0", "part 18", 50, 141, 141),
    ("993b6c85b234602a7c14b6f3b52e4911f89c23f906eb758dd570a3e96fb84785", "GPL-1.0", "part 19", 50, 188, 188),
    ("974775a7b27c790c4080657cd9285c14327355a8ca1d9ee4dd1a0d1d16767357", "GPL-1.0", "part 20", 50, 217, 217),
    ("71a836946d04826a755da3e9401f1187be1b3385fa5b7a7b449d00f0e731b282", "GPL-1.0", "part 21", 50, 148, 148),
    ("515fafa944a434250e9b58b5d5564fa42dc337f51301d4431250fca15c065662", "GPL-1.0", "part 22", 50, 283, 283),
    ("3f17afaeecb04ac06f3c03a404140e3ef4ace5faf0ccaa7eac04d17a1ba272e3", "GPL-1.0", "part 23", 50, 247, 249),
    ("6ca5ed8e00214b175290aa04b107a7a8d806fb2fd06a7cec51e68f6304f06667", "GPL-1.0", "part 24", 50, 445, 445),
    ("4f4ba6a69b4ef56c6e05c25f603b14c8ceac22bfdd0acef0f9d7677c5e721477", "GPL-1.0", "part 25", 50, 505, 517),
    ("a7c5aac79884753756fbd795837ec3f54d49997f79f6f8de62a3e674a7514e52", "GPL-1.0", "part 26", 50, 170, 172),
    ("d1b05ba3f5bdc7b167c2f5ae1c1c61d83b8ce8325d792556be67094ecc1352fd", "GPL-1.0", "part 27", 50, 326, 328),
    ("0bc63cb4708b823531dd95903f8ad1a5fbe6bf99d1b0e6d0297d5203c658bc11", "GPL-1.0", "part 28", 50, 246, 248),
    ("b9f35bfe8b9b4d91b66c63d8fcb22a1b4b1dcb3b08663243163e4c358d6312d2", "GPL-1.0", "part 29", 50, 437, 441),
    ("4a0cc55ae79ab133c3e3dd79f984d5bdeee5117661d112c5d10b42f48df795f7", "GPL-1.0", "part 30", 50, 478, 478),
    ("5f948da1f3aee4c914e38c63bdd865e42ed584c41591abafc94b4cca5add969a", "GPL-1.0", "part 31", 50, 11, 11),
    ("dbacc6de58570af1bd9b8206e86bd7200e48eb67e4c7c810043068c009e7a738", "GPL-1.0", "part 32", 50, 581, 581),
    ("cf78ecfaae7061a5d693875777ce4c2f88fffdf9ef6216c5c7a2d1cd4678417a", "GPL-1.0", "part 33", 50, 603, 603),
    ("9f4a72c489c21471cc17ea0070937c5763a53121bbf0718a5749b8ef05435557", "GPL-1.0", "part 34", 50, 27, 27),
    ("b33bf005fcddb6df38095f02a48955e90b93ea87b69146d02b35c396a0592c97", "GPL-1.0", "part 35", 50, 54, 54),
    ("849b89b04efd12b4d557318c03dd4ed2fd1e81040dc9ab201e5f2d038728d533", "GPL-1.0", "part 36", 50, 209, 209),
    ("3da8fe3ce0fa46667c9a4712bb7c634a6e0966d16fea7874e5d6698c058159af", "GPL-1.0", "part 37", 50, 268, 268),
    ("78be0ce2ec46e15d8907d83644caf6a98cbfca61e7e520613013f15755c286a3", "GPL-1.0", "part 38", 50, 68, 68),
    ("230eeee75b07fa71e4b1823e952c8e16292a543503bddcf2c8167da4b47a93d5", "GPL-1.0", "part 39", 50, 218, 220),
    ("3153b45862d1631a85b2cfb2be7d83ee1d7e88f4b08cbc833623e8d981d33b2b", "GPL-1.0", "part 40", 50, 228, 230),
    ("2614cc0e65f191976e74405d3c928aaad4131e78803e42745d43fbe32716ed1a", "GPL-1.0", "part 41", 50, 194, 196),
    ("08d075679ff0963d137622c6ec2e74bd9935d52fb8321c26b972d108f21a834e", "GPL-1.0", "part 42", 50, 71, 71),
    ("be346c0ff74cda7251963e0370ae4a19536bae9a7f5b4544e345faf5a497d9d8", "GPL-1.0", "part 43", 50, 107, 107),
    ("857c028326552befa27bacff490198ad2b871694080f33cec737e9e47643d2d3", "GPL-1.0", "part 44", 50, 234, 234),
    ("81b82df18e626ad4a8d2680cbae46cc9cfb35f5e7fb00ceff61e739930d31c77", "GPL-1.0", "part 45", 50, 265, 267),
    ("89e4049c2f963f84d36ef6498c1310b7ee19095c007698eae37319df7d301957", "GPL-1.0", "part 46", 50, 173, 173),
    ("9301061e12f773802062d734460204a72e5d73799358545b22b95b74de12f57e", "GPL-1.0", "part 47", 50, 162, 162),
    ("c0924fa00f68b8b4e2a4f48068b66a29c16b6fe34dd9b54a974725e75bb04551", "GPL-1.0", "part 48", 50, 59, 59),
    ("b3143badf03a3c8ec5637ec52198279304a61d088617f093f4d8e74eff48aad3", "GPL-1.0", "part 49", 50, 25, 25),
    ("7ea08d28d1753b4b04fe32ed91317fb0c926dc6fb735caa559250aef85e61479", "GPL-2.0", "text", 59, 17103, 17227),
    ("897f56e784a169d4722a4110c9f1cc395c76163d1e32089ab263ff2afb8fdeb3", "GPL-2.0", "part 0", 59, 41, 52),
    ("d096b5b4197a10a6073389fa1f08a8ee1e0ce8ac1ba4b34a698d58a2d75e62ae", "GPL-2.0", "part 1", 59, 172, 174),
    ("9a9b9a1c3f54a244a0f9fe66967769d25f166dcd6209e2c205ef50915e683bdc", "GPL-2.0", "part 2", 59, 8, 8),
    ("552466f80f2276d42525d00a5359c1574a272968f99f9c0ce3e70d8559b19dfa", "GPL-2.0", "part 3", 59, 546, 554),
    ("0686d2a0745c5030fb0a8bdddc5f7fd5052db5e2d06a3fb518692b57fbd6b3c2", "GPL-2.0", "part 4", 59, 399, 401),
    ("7ea3490cd136e23f34f4e5bc2d9148016b5c28de6067f6295412eeb3426d2198", "GPL-2.0", "part 5", 59, 259, 259),
    ("0f2c9ea9e20fb47269d12c6e25c2fdd1982cd2d835a776b986a4b38992b7e9e5", "GPL-2.0", "part 6", 59, 269, 269),
    ("18442fdb3a23bbb1a6623619cb6ee2d71ec47f05f1d4de10db4812d23a94dc0d", "GPL-2.0", "part 7", 59, 170, 172),
    ("fd67f194410e043215cd5a4a333c7554828a31185aec0418c19882838fe48d56", "GPL-2.0", "part 8", 59, 365, 365),
    ("5d7db4cbac8903882e1de9176e2abf855aaae74e0bae932569c80573cacfac87", "GPL-2.0", "part 9", 59, 334, 336),
    ("b56a5e74095a5a82fe5abfc423bf152c935bb7105a5897be9f3faceaeb9ede35", "GPL-2.0", "part 10", 59, 81, 81),
    ("babf4896388ec979a002db2fbc0d24076cecd03256f32b99565bcb76eab5e41c", "GPL-2.0", "part 11", 59, 89, 91),
    ("719b3bfcf5bd10a41d53c8f1cb072a115c76f2359f86d2e1158670ab3394064c", "GPL-2.0", "part 12", 59, 591, 595),
    ("bf0481752e479f66d03d738bcc0ae6bffdf66456a253dd38fe1091defd3bc1cb", "GPL-2.0", "part 13", 59, 379, 381),
    ("b9a93b1760d2019a160cb72015383dd27082686c56aaa7e77ad1b68dabd3d605", "GPL-2.0", "part 14", 59, 417, 421),
    ("412f56d60a5b82134efb7d5998f8efef7cc134d9ac9f51ce7927b16f1a205808", "GPL-2.0", "part 15", 59, 139, 139),
    ("ccca24795f5ec24af309c27a8fb82171b52f5db8b64bcf50626f25b73187e061", "GPL-2.0", "part 16", 59, 251, 251),
    ("c20ee2b91266866b6f20f2bbbe2a9f35a7f86461331092094dbfdb967335dd67", "GPL-2.0", "part 17", 59, 124, 124),
    ("1d31b6060ac2bf08784c1f311fe96e88c5b4434d0c417bc6391967ef81042a94", "GPL-2.0", "part 18", 59, 233, 235),
    ("00e71c0fd4099ba404628a4f53429fe46d5e59a6b5591a26545bd0f1265fe680", "GPL-2.0", "part 19", 59, 612, 614),
    ("a0c65833a9a85f467d2bdc74073999de0d1ada98b8312696747552d4c89941ad", "GPL-2.0", "part 20", 59, 600, 604),
    ("adc9258d0c598ca8cbcae2fe7a9ed4718e19124485e0338d3474c910b07b293a", "GPL-2.0", "part 21", 59, 238, 238),
    ("854448fa7d3934cc22680226f4b30e4e3daedab5d549bc49d3c6afa7075c8503", "GPL-2.0", "part 22", 59, 232, 234),
    ("b1e466c20b4614a3ac675e79f1e769950bdb052a72bb229f2c4c4d9dbc765dfb", "GPL-2.0", "part 23", 59, 202, 202),
    ("b95bada32fe670852bac8e8059f0e69c629397ca051563b0ad1339355ea2cdf1", "GPL-2.0", "part 24", 59, 200, 200),
    ("2d5954b33de95faf474e74d2c22aeca54785cc26e83f68b35eba0e90c9e27272", "GPL-2.0", "part 25", 59, 354, 354),
    ("30718481a7d53d306a81ca6303ff3cc9dcf238876a61fe9ab6a099612bf634a9", "GPL-2.0", "part 26", 59, 292, 294),
    ("ae447415c255f2a3936f7005c0e0b422e0f04e93c2bd8dffdaee9264b233f136", "GPL-2.0", "part 27", 59, 626, 626),
    ("73b9d40c6b6c93a01e3ef46c7c4a93d3f96d4b4b61329f20fef0c4a635be5446", "GPL-2.0", "part 28", 59, 311, 311),
    ("869b8d6ff2fc9f25d787f7f210536adf7462e597d9d2592a1e209144c3894261", "GPL-2.0", "part 29", 59, 424, 436),
    ("9e7e4b1a40dd0f2b32bef2a3f62bb68e7371edcfdbec9b483c4aede5354aca7c", "GPL-2.0", "part 30", 59, 489, 495),
    ("1f4bbc5844c13cb68799771048c3fe6de06a575e5a4f162b4cb7c3c9b1456971", "GPL-2.0", "part 31", 59, 408, 412),
    ("d90515934d9469043e390910450718cbabbd46370cd4dfe790739b04aeb2cb17", "GPL-2.0", "part 32", 59, 788, 798),
    ("f3207b47b487e853abfca43d83ae4fe7af09efddab0dbfc566c547d2f05715ae", "GPL-2.0", "part 33", 59, 216, 216),
    ("b37d69ead60104eb364fbf3e98df6b55fe5a7811155828427afc1dbd37c59961", "GPL-2.0", "part 34", 59, 612, 614),
    ("1c7df6a7b7b0ab7404c8c4f6ee23d7da62c92f2a1fa87892bea27ce3263b4c8f", "GPL-2.0", "part 35", 59, 114, 116),
    ("de976b4891cc7df3d25535dd9b6f5deba927b869a33c3048898bc97eed7fe700", "GPL-2.0", "part 36", 59, 459, 465),
    ("98cbb7ed55bb5d0790479ae8bc8407746831f55a263c5863e232092f9fb2337e", "GPL-2.0", "part 37", 59, 246, 248),
    ("b1ec7f09b7927665c6df7da358579b6e4101ea4a3f7040b8441f304e3e38cf76", "GPL-2.0", "part 38", 59, 439, 443),
    ("482b6b93621af9bc784bdf36e10ed2020dfa6dea1688cdb85d86e73f5dca77b5", "GPL-2.0", "part 39", 59, 479, 479),
    ("5f948da1f3aee4c914e38c63bdd865e42ed584c41591abafc94b4cca5add969a", "GPL-2.0", "part 40", 59, 11, 11),
    ("134e8ecabacb867ede1aad018bd352565dbb720c6b48e0af40725938d3dcd07e", "GPL-2.0", "part 41", 59, 582, 582),
    ("f916631d736b4a41c2879eaaeaf396aa17e70b9242f9f8dec250fe034c199c21", "GPL-2.0", "part 42", 59, 603, 603),
    ("9f4a72c489c21471cc17ea0070937c5763a53121bbf0718a5749b8ef05435557", "GPL-2.0", "part 43", 59, 27, 27),
    ("cd9b66accd2db4a8bb1a8175473701ed3b31de8277dccac80f5991916a2d1640", "GPL-2.0", "part 44", 59, 45, 45),
    ("77bfe530c2d8ed4d34e248a40690a793501dd86eef609b85774da8df404d8a08", "GPL-2.0", "part 45", 59, 211, 211),
    ("3da8fe3ce0fa46667c9a4712bb7c634a6e0966d16fea7874e5d6698c058159af", "GPL-2.0", "part 46", 59, 268, 268),
    ("78be0ce2ec46e15d8907d83644caf6a98cbfca61e7e520613013f15755c286a3", "GPL-2.0", "part 47", 59, 68, 68),
    ("387a1baa3b6e943a46430ce6d4742372784971a5d94c54933cc4b02dacbea74d", "GPL-2.0", "part 48", 59, 228, 241),
    ("3153b45862d1631a85b2cfb2be7d83ee1d7e88f4b08cbc833623e8d981d33b2b", "GPL-2.0", "part 49", 59, 228, 230),
    ("2614cc0e65f191976e74405d3c928aaad4131e78803e42745d43fbe32716ed1a", "GPL-2.0", "part 50", 59, 194, 196),
    ("08d075679ff0963d137622c6ec2e74bd9935d52fb8321c26b972d108f21a834e", "GPL-2.0", "part 51", 59, 71, 71),
    ("be346c0ff74cda7251963e0370ae4a19536bae9a7f5b4544e345faf5a497d9d8", "GPL-2.0", "part 52", 59, 107, 107),
    ("858f7d3b623aa0aca7df9892295504e40d51f3233a532991f6be08da10ec8ae0", "GPL-2.0", "part 53", 59, 234, 234),
    ("81b82df18e626ad4a8d2680cbae46cc9cfb35f5e7fb00ceff61e739930d31c77", "GPL-2.0", "part 54", 59, 265, 267),
    ("5c6b7793629f6628caee0b5cacc1fa1ffa16904a70d5b611e974fe516fe0f7d9", "GPL-2.0", "part 55", 59, 176, 176),
    ("6f4a99d92d5fa6c3f6346d246f998e86028b258924e372750cc72b7236346206", "GPL-2.0", "part 56", 59, 135, 135),
    ("c0924fa00f68b8b4e2a4f48068b66a29c16b6fe34dd9b54a974725e75bb04551", "GPL-2.0", "part 57", 59, 59, 59),
    ("e143425c621a291b79a91d5fc40a3f7027efbc9fd2683dce24355e834a2b3932", "GPL-2.0", "part 58", 59, 325, 331),
    ("a133babfef5090d60db16f5e603e9cec6206aa2375613d06f2bac87eef0a30ba", "GPL-3.0", "text", 122, 33372, 33632),
    ("10c3854c70c10808f2f455ff7ae311088ab9dd94c2c06693fb750f4c9e482943", "GPL-3.0", "part 0", 122, 42, 53),
    ("aaf9385eedc0e8797f25532c8f623c05bba02ebe7b124aefa1352367290a485a", "GPL-3.0", "part 1", 122, 116, 118),
    ("9a9b9a1c3f54a244a0f9fe66967769d25f166dcd6209e2c205ef50915e683bdc", "GPL-3.0", "part 2", 122, 8, 8),
    ("b9bc58918452a1fb3a47d82e6b0ab789ecc90bb85624102450640619c372c2e7", "GPL-3.0", "part 3", 122, 95, 99),
    ("eed5d0bf4ed70f3902521afa25e66ff7da68716b4053d5ae61d5ff58c0984f18", "GPL-3.0", "part 4", 122, 504, 510),
    ("17e89e5ad872098301dba8a8f3c600c6fc53ebb3d0c86f8ca53f7fe89c4eb766", "GPL-3.0", "part 5", 122, 391, 393),
    ("f77f6a478405269321651be66aba4f94e25cb99d4dea96713b975b6eae309ff7", "GPL-3.0", "part 6", 122, 271, 271),
    ("f04c738485d21da8f8004139622fa7b5801d3fa95834d3479042d01b40a4dda1", "GPL-3.0", "part 7", 122, 282, 282),
    ("136fd365f4de7a49aba9c93484456362b9cc57e273be6a6ca953cd97db0bde34", "GPL-3.0", "part 8", 122, 194, 196),
    ("a734c82252487b89f0cf19b351250581bca3609bc4caee786ead0a7b97657b81", "GPL-3.0", "part 9", 122, 298, 298),
    ("e1efdd7f3eb2b067be4a313b69e8d074423a7d09e3891bb1b3264bc7081f67e0", "GPL-3.0", "part 10", 122, 663, 663),
    ("1fda13a050511ac96b46be3a1f281a7f20a324c577d29b7a98b58f9d7087a7aa", "GPL-3.0", "part 11", 122, 396, 396),
    ("b56a5e74095a5a82fe5abfc423bf152c935bb7105a5897be9f3faceaeb9ede35", "GPL-3.0", "part 12", 122, 81, 81),
    ("e918ed85b7fc2eeeaeef3c049261de28f0980e045930b0693c17bfed7e57cfff", "GPL-3.0", "part 13", 122, 20, 20),
    ("275d388a3b0fc15b578b49625b2fc4b865dad97cdf4f9c29539f2d09d7dd04a8", "GPL-3.0", "part 14", 122, 13, 13),
    ("48526048138c0bc995f14796a50672f1789be73d71f85d5d4d0acf2d6a663a0e", "GPL-3.0", "part 15", 122, 59, 72),
    ("34e0d5d5682dcf814f203ff33c9fe4e5bc2cab1b44e98ec51f411cbf718a195f", "GPL-3.0", "part 16", 122, 103, 103),
    ("5ede777885330378a4cedca4532dbf8298393125f34257b2966d1449b1a002d1", "GPL-3.0", "part 17", 122, 167, 169),
    ("b793c33bbc9c0c88bc6e85db4ddeb7e5860da7d59e1f634026dca5d7e79d98d9", "GPL-3.0", "part 18", 122, 255, 255),
    ("3fc11371b34c462bf0450d3b98bbaad1e71a668641c44f6fea5bccf8c87e0ff4", "GPL-3.0", "part 19", 122, 81, 81),
    ("78d5ed94fb183f06a48a249ef677df53da0097e6e627f2f413fcddb8231fec56", "GPL-3.0", "part 20", 122, 377, 377),
    ("b620aabcc5545563a9d488cd117d2c19acef2433c562326465c6f6e3aebfcd07", "GPL-3.0", "part 21", 122, 199, 199),
    ("9e2e62c9027ff561f2b2de185149caa50f96f8f3a805a917f8aed88a313419de", "GPL-3.0", "part 22", 122, 517, 521),
    ("8b5e816100afbd99e68e17b1380cddb518ffdbeb0d24a79e187f6d23b4beb698", "GPL-3.0", "part 23", 122, 13, 13),
    ("3df6d95e0b8234cc89e18f7061a9c82f6b7a8c7f019dfceca16fdc9f7b8951ff", "GPL-3.0", "part 24", 122, 142, 142),
    ("20acb9b739d7fabc9a502f647e8e015f6a3e477f42b5b31d6c965390491f684f", "GPL-3.0", "part 25", 122, 257, 257),
    ("b73a5538d4f7abca25b508a9910d877de65880761c2dc76bf1f978b05bf16c49", "GPL-3.0", "part 26", 122, 644, 644),
    ("5d2681324e10799f26af9a1582b6a54ea5faafd80ec201955d2e6aab40fac857", "GPL-3.0", "part 27", 122, 780, 780),
    ("dcd3c6fcca231313b52d260ad9c871095347b38ec6b1accb5e1c4f93afec762f", "GPL-3.0", "part 28", 122, 135, 135),
    ("52613b43b56eda263aecb37204038319879480bb85440a4efc5ba169c8a9455a", "GPL-3.0", "part 29", 122, 73, 73),
    ("ff67fe18b0b1698e6315f1c4195b75047c965ff537c80d9f3ed813f1c786f3a3", "GPL-3.0", "part 30", 122, 19, 19),
    ("c007e65ee8951f271708bb1267371328f72c5729c7b3cf4f02cf3d81eb454639", "GPL-3.0", "part 31", 122, 466, 474),
    ("6055e3311c73858c543bd371d79173e9a6a49130d8caabcd64c2cb58941f84fb", "GPL-3.0", "part 32", 122, 669, 673),
    ("75b2a83776c2b4a0c79cc55aa46b4d1b3726489c53c94eb3364bd88802f9c263", "GPL-3.0", "part 33", 122, 153, 153),
    ("2e959c6c86d7b151750f53828d501e04bc6c88e739d41856006a8bf55594611c", "GPL-3.0", "part 34", 122, 59, 59),
    ("03816aac4adece42af2a31b8e2b9d64b52565ad209a3e9177ed41ddaad20314b", "GPL-3.0", "part 35", 122, 270, 270),
    ("5ef37b771ae0f9036e1ddf2e3cf4401519a0b81ab79d1bb201c658ade8924fc4", "GPL-3.0", "part 36", 122, 436, 438),
    ("650d5fd72926666d2d629b0d5976c62436c40df01b9db7922d278dca7ff1d84f", "GPL-3.0", "part 37", 122, 27, 27),
    ("a942b4a658f4ba3d3d2a99533ee72849668ace15ed4e45d2aea800a71e171330", "GPL-3.0", "part 38", 122, 447, 451),
    ("5007b9bb186ba0fc8885d25c6989b1873c0fa93f95184ce1bd4a0de81fb48624", "GPL-3.0", "part 39", 122, 125, 125),
    ("83934d393d1c935f198ef3a815f795fd919a98de60f637f404ce40d920fb01cf", "GPL-3.0", "part 40", 122, 36, 36),
    ("a8eebdf652d28341aa50ece8b556bc52d1fe208c63d94f48e03623bf08fa78e9", "GPL-3.0", "part 41", 122, 202, 202),
    ("e2f4306c1ca460cee0ff228828abdea62b208c41d3beb146fe10ae126d49d267", "GPL-3.0", "part 42", 122, 95, 95),
    ("6e67505a441cb5c08c6b031c47ac23058c5870c19bbe8162d118b1998462dd14", "GPL-3.0", "part 43", 122, 209, 211),
    ("05f64e29bad26d6b43e04a0bac7175839112e5e8d1f595174a12e2bcdf844834", "GPL-3.0", "part 44", 122, 424, 434),
    ("e0bf7038393e1b5d2c3fa162791b74ac42e5211e59420a452a194411282265d7", "GPL-3.0", "part 45", 122, 220, 220),
    ("cf4e80eb3932af36efb81482fe5bc3d3765be975d254b35250dd49ed81c01dda", "GPL-3.0", "part 46", 122, 559, 561),
    ("87eaf715ae5abb2d7139624b290edaf12975178a1142b339a345f21a7a116657", "GPL-3.0", "part 47", 122, 28, 28),
    ("425dca8dae1f1181a73885cf809888f69652e7e83f890a8dd7db7a867e53bdfd", "GPL-3.0", "part 48", 122, 210, 212),
    ("2aa625a9d7c8d410d09b9257ee458e9de4b1a412b1f31f1d3b8d1d83265f1d05", "GPL-3.0", "part 49", 122, 219, 219),
    ("16bb8dc9fdb62fa67e975eab3f9ccb3564c9c96bc3abd7dad172470326a50c12", "GPL-3.0", "part 50", 122, 658, 660),
    ("11a117bba57869bde15075b61f81946599a230d8556694225fd4ec965e365f2d", "GPL-3.0", "part 51", 122, 269, 269),
    ("38c710ce967ceb8f18bc15ea39b3cf61d8de3e30b20021f7225a034fa40b64e1", "GPL-3.0", "part 52", 122, 756, 756),
    ("f2f329f3fb35a25bd1ffa629f1a847c821962d9f87d833504361c5728f71c2bf", "GPL-3.0", "part 53", 122, 220, 220),
    ("2b168657ca31a74aae1a0396ad25fb083e85711017173748e264e2d423f3af21", "GPL-3.0", "part 54", 122, 173, 173),
    ("7d51c00299f5e4bd54f6674c88cc31b5a7b924dcebdfbad529e887cb232958c7", "GPL-3.0", "part 55", 122, 805, 807),
    ("7e069d3a37eb66682e5c057cce22325ad5469678ead13882aa6207e3e8bd3fa0", "GPL-3.0", "part 56", 122, 436, 436),
    ("ef0b400f97b30948eb078a7c643e8ae92b6c27639745709c17d02608aa5cad21", "GPL-3.0", "part 57", 122, 628, 628),
    ("7bcc74a18ac967a95547d1198591cc6da8dbac4f56a0068c354eefd66fac221d", "GPL-3.0", "part 58", 122, 470, 470),
    ("958afff48b9e0e489c2081ead755577611c793db5e6897a67a04606b7deb7c67", "GPL-3.0", "part 59", 122, 291, 291),
    ("3d02334bbdaa31b36e6a4dfb85ddcf5be4cd8dfd3f8a21f9c4a1d7e20f9dc22c", "GPL-3.0", "part 60", 122, 18, 18),
    ("fe5917ab958d08d28c26152331e789eb9dae40ff64dc1b8992fdb35abaf39af7", "GPL-3.0", "part 61", 122, 530, 536),
    ("7f49f94647264c581c2f3ebd85c267cc2f26b7e009dfed3c8506aa5eb813603e", "GPL-3.0", "part 62", 122, 388, 388),
    ("328c8bc1e86822cc6c32fade1f40c0c0a934b3f86c0dbf5da98c5cda387f0adb", "GPL-3.0", "part 63", 122, 202, 206),
    ("9aa2eeabf1930117299d2143e29b2cba52db448fdfb35e8dff43d78fb60aee7e", "GPL-3.0", "part 64", 122, 112, 114),
    ("04baf379f745729f744d0e3f4a74570328082f8e91e146941a3ed7c858d01d0b", "GPL-3.0", "part 65", 122, 174, 174),
    ("05098ff75cb75429b5e0a86e3a8ecd9bab840fee31ee7f352381ef9414e2b2b1", "GPL-3.0", "part 66", 122, 186, 186),
    ("268c4a0109d675d6b4276fbf70d27085968159d98e503e1d960dc7164764479e", "GPL-3.0", "part 67", 122, 93, 93),
    ("4889ac662be541e72c741c99e6fae51bfe03583e12f88988bbc110330cdeed38", "GPL-3.0", "part 68", 122, 106, 106),
    ("35c5f7f8a5ed6586bd8f26c554c2f614265b2577652036deb811c775e8652ac5", "GPL-3.0", "part 69", 122, 290, 290),
    ("ea7b4aa09d092b428515e34bdd49c637a24f0792f56b1cf24c4e7efe9ff1fecc", "GPL-3.0", "part 70", 122, 577, 585),
    ("4036053d1f41aee34f670d952b69217c8ab7846884a890b1e83d51a7ebec0252", "GPL-3.0", "part 71", 122, 226, 226),
    ("9723136bed1b37e9a70c1198188006161d3135dec634ea6050cd22085aa1042f", "GPL-3.0", "part 72", 122, 167, 169),
    ("4e7f296565343f18ec0333d65b71e75a26b3e5cc834457d076f7b57ecb24929a", "GPL-3.0", "part 73", 122, 13, 13),
    ("c06a19695e870c5e43ebfaf323d459adae09fd5a02c310f154e178fd63ba1e7b", "GPL-3.0", "part 74", 122, 291, 297),
    ("e9809a959d6872db36eca125fc35dde5086eeafd9a19ffdc28e22bdecf922205", "GPL-3.0", "part 75", 122, 359, 365),
    ("26d763024919e0b5e44b5f00fc11aede6a854c4d3b20b8010b5f50d5d56467b9", "GPL-3.0", "part 76", 122, 355, 359),
    ("cee074225b64c8f7311e8ef36c5b85f3860c09bcc4ada44621dcda8efa83c5d0", "GPL-3.0", "part 77", 122, 298, 304),
    ("90ad9ebc76c2db25829ebe2497fb8c6554b4c1b11ada63e852b3feca381fb455", "GPL-3.0", "part 78", 122, 43, 43),
    ("505a392545b156c448cd9013c6fb7af0ef74617126540cd7244e2d50ee140aee", "GPL-3.0", "part 79", 122, 532, 540),
    ("c58a22e2ba402d9f5bcfa085cbb74775b1402b86797110852adb6e1adb8e54f0", "GPL-3.0", "part 80", 122, 47, 47),
    ("d40279e18ca6d3e72e624ecf2d92dd9453c5d5e99809755267a18f74bb16fbc8", "GPL-3.0", "part 81", 122, 256, 262),
    ("ea3defe9384bba4257196c94c83abef336a7fc046d15eeb0312e30dc145ef5fd", "GPL-3.0", "part 82", 122, 590, 592),
    ("b596e61fb1ef384b55daf6cb7585d18884b51706da444ecc08aeb0c19ad08c22", "GPL-3.0", "part 83", 122, 452, 458),
    ("4a99542560e420d134b33fa4b71c26a91a9e31f4fe1713641933c6b10be6a14f", "GPL-3.0", "part 84", 122, 10, 10),
    ("bffbad0d5473219cd6e7d6b03cf23cc687bb4ea7494e1498323f6be1f95e3931", "GPL-3.0", "part 85", 122, 199, 201),
    ("5d90cf132c255b45e7f079eab55a7ce0a9be3d0bd5d47a3e10f72a44444d16bd", "GPL-3.0", "part 86", 122, 534, 538),
    ("24f2ebd7aab34e19e65156a09a2d8b194f7cd114e47f9419cfc2043f8ef6b8ea", "GPL-3.0", "part 87", 122, 247, 249),
    ("acc29d84983737aef6193e2bc0f272ec338a1b41e7f453df209ff078db177e3d", "GPL-3.0", "part 88", 122, 361, 365),
    ("3179fc4f9f6caa46fdec72b3f1f352185d81431c8caa473d281c2d8f4fbfd935", "GPL-3.0", "part 89", 122, 858, 870),
    ("327623fbd06861cddd9500866807e31a4effe57f5b64934383adab3157ba4ea5", "GPL-3.0", "part 90", 122, 422, 426),
    ("98921254b087152778bb3e8fb1c865bb0093dce5e9d2548c42c99cb6d1581acb", "GPL-3.0", "part 91", 122, 917, 925),
    ("a700c02424bcafa0a463f2b2648495dd5afc1737d8f23ec8c7f41a1b51f9ac69", "GPL-3.0", "part 92", 122, 188, 192),
    ("57ada9bd1ce567e4590340e08e5f81d9c492b64be2c3b23c8922409a92b16ad1", "GPL-3.0", "part 93", 122, 33, 33),
    ("4c3f0c3855f9e83b9cebb8776564f0d802c315219ba4f77f1101834cbcb3b75c", "GPL-3.0", "part 94", 122, 633, 641),
    ("23aac8385ddb1ddc96ae93ea8dc9ee93897249316e1e078aed43593d4b17fd8b", "GPL-3.0", "part 95", 122, 49, 51),
    ("8358608fea225d03e3edb1fcd2f5de37c4d8b93a09168cbccbc327c6e4b54b2c", "GPL-3.0", "part 96", 122, 486, 503),
    ("3c94d1e6a1aff484c9e9188091bf518b84e81a853c4882a640eca833e2ecdede", "GPL-3.0", "part 97", 122, 35, 37),
    ("89f1c89236bcfd32904d6b4e9e1b9cf3a0957e7cb30d7f422ec176d5d17374e1", "GPL-3.0", "part 98", 122, 248, 250),
    ("e14afa7c47e95e34bef07df2a41a22b33459e6967d976e200fca2ef25d06d58d", "GPL-3.0", "part 99", 122, 492, 496),
    ("a525092d6bd6c2616341cce7abed301b5937656589faf0fa1fb7257cb481b09f", "GPL-3.0", "part 100", 122, 239, 241),
    ("4ac5e4bab22b1ba9d60e9f4d09884f164b378ccfa98e3ba6de4ff42f8533b826", "GPL-3.0", "part 101", 122, 206, 208),
    ("65c1fffd77ea5abbd2b27b25a13c12b1ade3c0b6a249c57d58356b0a11664e62", "GPL-3.0", "part 102", 122, 25, 25),
    ("8752831a938e02c9e8442a6e38d1d4b057fa17fe0a90280c1521f0caa58fe702", "GPL-3.0", "part 103", 122, 532, 532),
    ("dcd6702a4efd4e4e1ad18a9f2ae89bdd684d515187d5480ec735e9b97657647e", "GPL-3.0", "part 104", 122, 26, 26),
    ("d1f8376f7d463f69530e9d10acab26d359dad8ec074a88096d26ccb341f1a3ab", "GPL-3.0", "part 105", 122, 593, 593),
    ("7baa0d94368b20b13b26d5159c473eb06ff6015c576af0be117eddbda1f9b3a5", "GPL-3.0", "part 106", 122, 39, 39),
    ("48a4d882922a119974529b7dd8d65586761edd96ab35666139086d0c7802222f", "GPL-3.0", "part 107", 122, 374, 374),
    ("9f4a72c489c21471cc17ea0070937c5763a53121bbf0718a5749b8ef05435557", "GPL-3.0", "part 108", 122, 27, 27),
    ("cd9b66accd2db4a8bb1a8175473701ed3b31de8277dccac80f5991916a2d1640", "GPL-3.0", "part 109", 122, 45, 45),
    ("77bfe530c2d8ed4d34e248a40690a793501dd86eef609b85774da8df404d8a08", "GPL-3.0", "part 110", 122, 211, 211),
    ("64b56fcb218f246b22c89f7af91e0adfa4e0b24009b2ec6128c1f826999208ea", "GPL-3.0", "part 111", 122, 267, 267),
    ("78be0ce2ec46e15d8907d83644caf6a98cbfca61e7e520613013f15755c286a3", "GPL-3.0", "part 112", 122, 68, 68),
    ("66237b20dfaa335f5c003a3da64555538643deb65ca015c0d5fa588527312c4e", "GPL-3.0", "part 113", 122, 226, 239),
    ("3153b45862d1631a85b2cfb2be7d83ee1d7e88f4b08cbc833623e8d981d33b2b", "GPL-3.0", "part 114", 122, 228, 230),
    ("838ae99f77267d6120419c41bcf7cc587437a7a206059601b3f884e1b285076e", "GPL-3.0", "part 115", 122, 126, 130),
    ("08d075679ff0963d137622c6ec2e74bd9935d52fb8321c26b972d108f21a834e", "GPL-3.0", "part 116", 122, 71, 71),
    ("b38fdc5dc347039540894835af6e4c1d9005589fa53f64bf67d960b3773ff285", "GPL-3.0", "part 117", 122, 118, 118),
    ("872bf1b550640b58b456218d500c2e6f99f010b151b140431719f281fca7091c", "GPL-3.0", "part 118", 122, 220, 220),
    ("19c7090173e00468e6264eedeed216853b752762d547992815f9ac267365fa26", "GPL-3.0", "part 119", 122, 207, 209),
    ("d34036b771b52ec74f3b487de31651f5759e9f693b5963c55f93f9928b131453", "GPL-3.0", "part 120", 122, 237, 239),
    ("be2552893245d3524a08b427df867fdeef5d7b1c8df5b735f39acdcdcda9c1e3", "GPL-3.0", "part 121", 122, 394, 402),
    ("395177956b39c3edac318083bde57ff4fc22914806ca5f1953b1323953583e75", "LGPL-2.0", "text", 83, 24100, 24291),
    ("076fc1e47eff354c2ce49d1f010c893afcaafa3026f25420a27b0e5e3fbf3ce4", "LGPL-2.0", "part 0", 83, 49, 60),
    ("d096b5b4197a10a6073389fa1f08a8ee1e0ce8ac1ba4b34a698d58a2d75e62ae", "LGPL-2.0", "part 1", 83, 172, 174),
    ("78501438964d70ac45a8024f66acea4bbec86da3d15426ebb6c4226774d9736a", "LGPL-2.0", "part 2", 83, 116, 125),
    ("9a9b9a1c3f54a244a0f9fe66967769d25f166dcd6209e2c205ef50915e683bdc", "LGPL-2.0", "part 3", 83, 8, 8),
    ("23857df8361c40c99bc6bba9939a7df01dbd657ab3bc81748823826c02061310", "LGPL-2.0", "part 4", 83, 259, 263),
    ("9b39b37569698508f1b75b1cc814dfaa3d53c1639825ff41e6b88db7b955a1e1", "LGPL-2.0", "part 5", 83, 214, 218),
    ("0686d2a0745c5030fb0a8bdddc5f7fd5052db5e2d06a3fb518692b57fbd6b3c2", "LGPL-2.0", "part 6", 83, 399, 401),
    ("f380dfc6d56253d8f37154d7bbdec47a91320231e5baacc011b6d9fc42b36858", "LGPL-2.0", "part 7", 83, 258, 258),
    ("c8aed4b5af7a476fbde24c8ba252b26c28979b848cce9afdc14aacbfe196356f", "LGPL-2.0", "part 8", 83, 466, 466),
    ("5fb582937f208d3373418a27660a7466d289b0b212a111a3b3f00fb103eb261c", "LGPL-2.0", "part 9", 83, 181, 183),
    ("db4b01ffe10ceb82a8afc89f16bccd73bf73e63da6d15476b8b79bad6840c934", "LGPL-2.0", "part 10", 83, 367, 367),
    ("2d39bd08f3acf8809a19c1319ae1e094d9926fc08eaaf3a91e467eb4534924c7", "LGPL-2.0", "part 11", 83, 363, 365),
    ("e759780161ddf548d63870a1f89ee13af9df306d16c99726488207f7222f368d", "LGPL-2.0", "part 12", 83, 385, 395),
    ("0ba96305040a353cfa8cd8249d1a82954ea31410db1513c298041000fd3fd169", "LGPL-2.0", "part 13", 83, 520, 524),
    ("df16be5d61be8f045d92a8c072a4cfe6634d2b3cacbce9b4d0c2fdab3ef6e219", "LGPL-2.0", "part 14", 83, 251, 253),
    ("55737b258225fbb1e0f2ba2e60ebca5a39572aa0a1599b742b6e853b3bba4f3c", "LGPL-2.0", "part 15", 83, 609, 611),
    ("5016ac9e798f8c8272bfadc3ee63355a6b37c98dc22f35b7078c408834efc78e", "LGPL-2.0", "part 16", 83, 292, 292),
    ("435145b7fdae75a97d683378d346fb0f5f9d963c5516a32d5b94d5ec352992c5", "LGPL-2.0", "part 17", 83, 123, 125),
    ("39dd2def86ea2f92cd1532950d330dcc9ebf7817c7fbd075ad524bbbaf237361", "LGPL-2.0", "part 18", 83, 97, 99),
    ("713062b3fc3139b29143c5bb514e2b05857751a1e0336ca18e74a44a3c945ca2", "LGPL-2.0", "part 19", 83, 280, 286),
    ("29f2f9b62d6cc8352e229aec3418286b9b62d499de9407eeca7387b4f427e2fa", "LGPL-2.0", "part 20", 83, 192, 192),
    ("25baaffe5a280702cbb446f7ee889b2524059a268f91a7e9fce67619875016c3", "LGPL-2.0", "part 21", 83, 442, 442),
    ("ed241ee0e0a4a48ce0019b131432c3808f219ac018f3fc5a88d4d97fe7a4b720", "LGPL-2.0", "part 22", 83, 303, 303),
    ("7e4654534613475d4541194d423bdc16cd9734bab3b7baa6c30cacf0ef7b5192", "LGPL-2.0", "part 23", 83, 450, 452),
    ("edd027ab1f7834469723ed514d28479143858d9a59e522aa50d96ac885740d20", "LGPL-2.0", "part 24", 83, 396, 400),
    ("412f56d60a5b82134efb7d5998f8efef7cc134d9ac9f51ce7927b16f1a205808", "LGPL-2.0", "part 25", 83, 139, 139),
    ("09aaa6cb05fc5cde8bc82e138e0db1f34486e9ad25b544eed6dfd34b4e5b8814", "LGPL-2.0", "part 26", 83, 251, 251),
    ("b5a03743c4f8d89041c689663b43bc06caaf7a6441f8d3480cb51bbbe371b6d2", "LGPL-2.0", "part 27", 83, 53, 53),
    ("270f41e760b986fdaa9dda5f5a87a621bd30667aa18787e226d76caf1e017c15", "LGPL-2.0", "part 28", 83, 124, 124),
    ("a5c6969f1877bc0c9e2d202c3441c67e8a5976bf2921608bd53e7d7882ed37ed", "LGPL-2.0", "part 29", 83, 119, 121),
    ("3d9c0010d97d625575975859099ecdc8369504364611936bc34311370053f975", "LGPL-2.0", "part 30", 83, 415, 415),
    ("aedf03c14e2d23b5d6f207b285a1cfee484fab9a21ffd05cf2ff19e65a409c4a", "LGPL-2.0", "part 31", 83, 349, 349),
    ("57de73381522a9cf977efb4950642f78321e6d8babacdd549a73d75babc1c403", "LGPL-2.0", "part 32", 83, 600, 604),
    ("e36386486386b0d275e5f55e30ff616a69f9de92225994c1837f1675e813c032", "LGPL-2.0", "part 33", 83, 238, 238),
    ("5e21974f98c720ee61fff375ddc15692c97771549ae6e3476a8d054e4b25109f", "LGPL-2.0", "part 34", 83, 232, 234),
    ("b0a5398f9c2c75eaf4334ade06278e7f752bb65f933896e5995e1fca29ce065d", "LGPL-2.0", "part 35", 83, 478, 508),
    ("57ab0f497a9d1fcb7b8882d65bf2f96bf2d340d033a7bb4cac7594d8b6ae751d", "LGPL-2.0", "part 36", 83, 190, 192),
    ("485cf69b3d75a28b990d081d08f5d1be7215e6140d96a3d5984f3c610288c10d", "LGPL-2.0", "part 37", 83, 112, 112),
    ("645dc1834f709bbfeaa1c99b4e5178e2899909c53c2eba0fb4696ecd40409fb2", "LGPL-2.0", "part 38", 83, 380, 380),
    ("2f6d11746fe6b257bf7a7c4d4904ad8da998121e93084de031f42c78d8b4e8c9", "LGPL-2.0", "part 39", 83, 311, 311),
    ("8cffc61b738700f82d9ad41f961b214089fe08ce917a6cd5c39f4db847c5f142", "LGPL-2.0", "part 40", 83, 304, 306),
    ("434bff3d80b2ae2ef03f12a6b0f4436007de8847985004a89fc11b89ca6c201e", "LGPL-2.0", "part 41", 83, 316, 318),
    ("636d1a98fee11fadbee9a0746e8d8aa6361c3bb3853c75e4d971934e25c16d27", "LGPL-2.0", "part 42", 83, 392, 392),
    ("05bccf7dd5fab15282fe249465cbb73549ba86b3efe7faf7143393a815b0a3cd", "LGPL-2.0", "part 43", 83, 365, 365),
    ("2c968c2ad5141382dae36a987d855e69e385973722c27d3daef10322bef2759d", "LGPL-2.0", "part 44", 83, 256, 256),
    ("831f8304f03b197a9fc751225dd9f6098c1cc436dc6639e3d4ff454bf2b9b20a", "LGPL-2.0", "part 45", 83, 359, 359),
    ("fd6777d87952b926b8b3682f432726519120ed4dcd8c8f3a7ff2af422a76e835", "LGPL-2.0", "part 46", 83, 416, 422),
    ("bd7a2f804d6df8bc47ae3500e1d12d668674707f30d002e111d88b446bebc1e4", "LGPL-2.0", "part 47", 83, 657, 657),
    ("b4e6605c47c8158ea2418acdbf85afd81b96b000002cacc78673243f1868945f", "LGPL-2.0", "part 48", 83, 208, 208),
    ("ce1af8e971cccca29fd0ee6c85d4affc97b6e81fabbc30a18810caa5ce69a391", "LGPL-2.0", "part 49", 83, 170, 170),
    ("64ae52a6226f186d6a9dab73ed728e9df76d1dcd1509f6aebcedfae4119151d8", "LGPL-2.0", "part 50", 83, 116, 116),
    ("12a2e33e6fad236c255ca7b5a4011808fac825b5be344bcc040965747b12e457", "LGPL-2.0", "part 51", 83, 465, 465),
    ("91986c51411ac1c46cd5e1de92216542e2f7fefb401e4eebff372c11a83b5791", "LGPL-2.0", "part 52", 83, 269, 271),
    ("676f40ff34199fd74e972e9b0943d3afdcc168be109a0d0f8028770198858553", "LGPL-2.0", "part 53", 83, 384, 386),
    ("4387b3a84b6b6f7915c6ee30a0f02a13b5134c389422aee554b4f3a51738b783", "LGPL-2.0", "part 54", 83, 190, 190),
    ("886f2a656c203fe8e0e9aeaf780390ea37969fdf023e27ad495e3120d1d319ac", "LGPL-2.0", "part 55", 83, 187, 187),
    ("44ad0d26ecdbd4f9810c862bc751769781acc92d0023441f7136ca0612a7d044", "LGPL-2.0", "part 56", 83, 444, 456),
    ("25850e381f9e944ef892eb4bd0bf67ee75e2a1759452107e03436feaf759afce", "LGPL-2.0", "part 57", 83, 489, 495),
    ("84709cd6c5f1718746a3d57d35f3db31666df920b56b42036710a3a868eb632f", "LGPL-2.0", "part 58", 83, 419, 423),
    ("b5ba0baad0e2eb1daf6ef7021d0955d10d9a6ba785620fe3fd0aa693f1da05ae", "LGPL-2.0", "part 59", 83, 789, 799),
    ("f3207b47b487e853abfca43d83ae4fe7af09efddab0dbfc566c547d2f05715ae", "LGPL-2.0", "part 60", 83, 216, 216),
    ("b37d69ead60104eb364fbf3e98df6b55fe5a7811155828427afc1dbd37c59961", "LGPL-2.0", "part 61", 83, 612, 614),
    ("1c7df6a7b7b0ab7404c8c4f6ee23d7da62c92f2a1fa87892bea27ce3263b4c8f", "LGPL-2.0", "part 62", 83, 114, 116),
    ("72363341dba43e00cef645cf13f0ad007ada49c47d691c8c9b94d041569e3753", "LGPL-2.0", "part 63", 83, 460, 466),
    ("9a4157c8c233704cdf90de004c19df98bec1fb7115b28e28c09c0a3063454879", "LGPL-2.0", "part 64", 83, 255, 257),
    ("ff71cb100cc18ec647c56f0aae11136ef8e31fa2baac63ead1012499733101fe", "LGPL-2.0", "part 65", 83, 431, 435),
    ("a18454e7545be7331be87940283fccbf822e59c5fade6f01341537e988913a47", "LGPL-2.0", "part 66", 83, 493, 493),
    ("5f948da1f3aee4c914e38c63bdd865e42ed584c41591abafc94b4cca5add969a", "LGPL-2.0", "part 67", 83, 11, 11),
    ("bca0cb858ea41e06f7b2fbcd8f2986dcd4aa7d27c4309103538885b8ac9bead2", "LGPL-2.0", "part 68", 83, 582, 582),
    ("5b40378b7726b95842868dc342c3b30eb6d283aa106d2ec38bb3fb89745a0af0", "LGPL-2.0", "part 69", 83, 603, 603),
    ("9f4a72c489c21471cc17ea0070937c5763a53121bbf0718a5749b8ef05435557", "LGPL-2.0", "part 70", 83, 27, 27),
    ("8a0fc1e79caf5ca913776439f8c6da9dcd59ceb1641138fd848bd5c037c39115", "LGPL-2.0", "part 71", 83, 46, 46),
    ("e7bc631f142e338a1bca3480599d079932cd389ba0f8d16d4f9b695fcbbe5732", "LGPL-2.0", "part 72", 83, 305, 307),
    ("38a9150239b9197c78e7c73b5a7a791ebe181a9af90a2dfa7e8e52ed85e28dbc", "LGPL-2.0", "part 73", 83, 280, 280),
    ("711e6b8bdcaaa926cfa3b6125f6b42a8f6f6798981a26358f13d915cbb0302dc", "LGPL-2.0", "part 74", 83, 68, 68),
    ("9cec1b5064269664846e29e00f59928e9236c7f27a3b1d8128b0efb63b7a41bf", "LGPL-2.0", "part 75", 83, 236, 249),
    ("6e76c4058edf07dc20283d6c13273f94c297d2f5acf6bd00d1cea99f486793af", "LGPL-2.0", "part 76", 83, 236, 238),
    ("0668cd4435e307af7fea5dd3833e3052fedaeb549b9afb1a54b0778015bc63ac", "LGPL-2.0", "part 77", 83, 202, 204),
    ("08d075679ff0963d137622c6ec2e74bd9935d52fb8321c26b972d108f21a834e", "LGPL-2.0", "part 78", 83, 71, 71),
    ("95cef4f7d3c9c92dbd670ba7dd68c0df8b544ff47cec466cd23df760131c96bc", "LGPL-2.0", "part 79", 83, 176, 176),
    ("93e69e44fa77c3153cafc539b81d7459da9351f881654b42ebcab835a8b63eb8", "LGPL-2.0", "part 80", 83, 132, 132),
    ("6cf6fa34c8113bce9c9a5a9afc16d4cd4b5dee2699aa9277e89b2719aa72e1c2", "LGPL-2.0", "part 81", 83, 59, 59),
    ("b3143badf03a3c8ec5637ec52198279304a61d088617f093f4d8e74eff48aad3", "LGPL-2.0", "part 82", 83, 25, 25),
    ("b8528f33f7684ea4c6a3968e541a726e8495898371d048f2adc73f4befee7eb2", "LGPL-2.1", "text", 85, 25188, 25397),
    ("212d6a9a5fa30e3bfc84bc5e9bdd6ddb29dd8f3dca9d321d0c114cdafa4c11e4", "LGPL-2.1", "part 0", 85, 54, 65),
    ("d096b5b4197a10a6073389fa1f08a8ee1e0ce8ac1ba4b34a698d58a2d75e62ae", "LGPL-2.1", "part 1", 85, 172, 174),
    ("a66ae9ad8b3148d401ed52decaeb84ac6bacd551f5a6e6552222e8be4ca4c540", "LGPL-2.1", "part 2", 85, 152, 163),
    ("9a9b9a1c3f54a244a0f9fe66967769d25f166dcd6209e2c205ef50915e683bdc", "LGPL-2.1", "part 3", 85, 8, 8),
    ("23857df8361c40c99bc6bba9939a7df01dbd657ab3bc81748823826c02061310", "LGPL-2.1", "part 4", 85, 259, 263),
    ("e2b6a347383794e027cd6ee487bb9b1cc4fc4fb33a944cba5e1c2abb1589c7ad", "LGPL-2.1", "part 5", 85, 403, 411),
    ("63212aef93ffcc7b6f001fa59a5d5354ebfcac89d8f64f04c17e9b722e1a8880", "LGPL-2.1", "part 6", 85, 420, 422),
    ("a559932796881da4666d7030dd550de2972876b224acc8afc020f85e7e748514", "LGPL-2.1", "part 7", 85, 266, 266),
    ("bda22e706978307f738378f38e0728550bfaff0faaaa32ed0e5de5a0e9acc638", "LGPL-2.1", "part 8", 85, 467, 467),
    ("a1aefb8e0be41ba72d69fafa019e96d29f7edd8331c6933e205bdaa0fcd65e23", "LGPL-2.1", "part 9", 85, 182, 184),
    ("70378b4f70a5d005b122f42d38649920e0f1bd17435fb3289e3775cfb7874c9d", "LGPL-2.1", "part 10", 85, 350, 350),
    ("4d21c5a872aa63a2c1e4541de30afea5d5e04de935c8a6039f2e9af76d92f953", "LGPL-2.1", "part 11", 85, 388, 394),
    ("b8b7599e59c002ba34efd8fea1754374cd08882067ef1a5be1b4cd5ca746fb2f", "LGPL-2.1", "part 12", 85, 359, 369),
    ("abf5ce0ff69a649d7a792cb26abe2ea49fc3821e23e7fe8e964646ffed239840", "LGPL-2.1", "part 13", 85, 411, 415),
    ("fb3e47ab94769a573a340606a5634d895b05b74481766d9821761e547f10b217", "LGPL-2.1", "part 14", 85, 425, 435),
    ("9cc6e831f13a49d10c33f90031f1dee7722f0c674f73c2a8551dba17c1453997", "LGPL-2.1", "part 15", 85, 451, 453),
    ("3402351ace442e104b3ac5fdccbc2eeea9eeaf71b369e8cd9005a3c4111c26de", "LGPL-2.1", "part 16", 85, 332, 332),
    ("5259ec0f1ad2d2572d948abce72ee301345af39d41e5705c8205333434ed6ece", "LGPL-2.1", "part 17", 85, 252, 254),
    ("0c21029ef774f22ada839400cceae6fd10074d5f2eb601caf7e3318c926b8dd9", "LGPL-2.1", "part 18", 85, 307, 307),
    ("40499a7b1b07cadc5ac95536a7911a04753e19e23e697b84769bce3f93ab7a7d", "LGPL-2.1", "part 19", 85, 96, 98),
    ("b0ab9b33fee6ee7855917f9a7fe2ccca7aceed01b27c3fc4bb84483feab445d7", "LGPL-2.1", "part 20", 85, 296, 302),
    ("29f2f9b62d6cc8352e229aec3418286b9b62d499de9407eeca7387b4f427e2fa", "LGPL-2.1", "part 21", 85, 192, 192),
    ("25baaffe5a280702cbb446f7ee889b2524059a268f91a7e9fce67619875016c3", "LGPL-2.1", "part 22", 85, 442, 442),
    ("ed241ee0e0a4a48ce0019b131432c3808f219ac018f3fc5a88d4d97fe7a4b720", "LGPL-2.1", "part 23", 85, 303, 303),
    ("7e4654534613475d4541194d423bdc16cd9734bab3b7baa6c30cacf0ef7b5192", "LGPL-2.1", "part 24", 85, 450, 452),
    ("edd027ab1f7834469723ed514d28479143858d9a59e522aa50d96ac885740d20", "LGPL-2.1", "part 25", 85, 396, 400),
    ("412f56d60a5b82134efb7d5998f8efef7cc134d9ac9f51ce7927b16f1a205808", "LGPL-2.1", "part 26", 85, 139, 139),
    ("09aaa6cb05fc5cde8bc82e138e0db1f34486e9ad25b544eed6dfd34b4e5b8814", "LGPL-2.1", "part 27", 85, 251, 251),
    ("b5a03743c4f8d89041c689663b43bc06caaf7a6441f8d3480cb51bbbe371b6d2", "LGPL-2.1", "part 28", 85, 53, 53),
    ("270f41e760b986fdaa9dda5f5a87a621bd30667aa18787e226d76caf1e017c15", "LGPL-2.1", "part 29", 85, 124, 124),
    ("a5c6969f1877bc0c9e2d202c3441c67e8a5976bf2921608bd53e7d7882ed37ed", "LGPL-2.1", "part 30", 85, 119, 121),
    ("3d9c0010d97d625575975859099ecdc8369504364611936bc34311370053f975", "LGPL-2.1", "part 31", 85, 415, 415),
    ("aedf03c14e2d23b5d6f207b285a1cfee484fab9a21ffd05cf2ff19e65a409c4a", "LGPL-2.1", "part 32", 85, 349, 349),
    ("57de73381522a9cf977efb4950642f78321e6d8babacdd549a73d75babc1c403", "LGPL-2.1", "part 33", 85, 600, 604),
    ("e36386486386b0d275e5f55e30ff616a69f9de92225994c1837f1675e813c032", "LGPL-2.1", "part 34", 85, 238, 238),
    ("5e21974f98c720ee61fff375ddc15692c97771549ae6e3476a8d054e4b25109f", "LGPL-2.1", "part 35", 85, 232, 234),
    ("b0a5398f9c2c75eaf4334ade06278e7f752bb65f933896e5995e1fca29ce065d", "LGPL-2.1", "part 36", 85, 478, 508),
    ("57ab0f497a9d1fcb7b8882d65bf2f96bf2d340d033a7bb4cac7594d8b6ae751d", "LGPL-2.1", "part 37", 85, 190, 192),
    ("485cf69b3d75a28b990d081d08f5d1be7215e6140d96a3d5984f3c610288c10d", "LGPL-2.1", "part 38", 85, 112, 112),
    ("645dc1834f709bbfeaa1c99b4e5178e2899909c53c2eba0fb4696ecd40409fb2", "LGPL-2.1", "part 39", 85, 380, 380),
    ("2f6d11746fe6b257bf7a7c4d4904ad8da998121e93084de031f42c78d8b4e8c9", "LGPL-2.1", "part 40", 85, 311, 311),
    ("8cffc61b738700f82d9ad41f961b214089fe08ce917a6cd5c39f4db847c5f142", "LGPL-2.1", "part 41", 85, 304, 306),
    ("434bff3d80b2ae2ef03f12a6b0f4436007de8847985004a89fc11b89ca6c201e", "LGPL-2.1", "part 42", 85, 316, 318),
    ("636d1a98fee11fadbee9a0746e8d8aa6361c3bb3853c75e4d971934e25c16d27", "LGPL-2.1", "part 43", 85, 392, 392),
    ("05bccf7dd5fab15282fe249465cbb73549ba86b3efe7faf7143393a815b0a3cd", "LGPL-2.1", "part 44", 85, 365, 365),
    ("2c968c2ad5141382dae36a987d855e69e385973722c27d3daef10322bef2759d", "LGPL-2.1", "part 45", 85, 256, 256),
    ("f0f621274247d6f399a4c4d307312cf57e81756e729492da85b45c9c2759c045", "LGPL-2.1", "part 46", 85, 359, 359),
    ("fd6777d87952b926b8b3682f432726519120ed4dcd8c8f3a7ff2af422a76e835", "LGPL-2.1", "part 47", 85, 416, 422),
    ("bd7a2f804d6df8bc47ae3500e1d12d668674707f30d002e111d88b446bebc1e4", "LGPL-2.1", "part 48", 85, 657, 657),
    ("6353fefe0c7afa8073fb252b896ffcfa6f39b3a04d54495698d927b85b861e4f", "LGPL-2.1", "part 49", 85, 441, 441),
    ("3d57786e94c9a5b344660c6aebdcbbaa362bd7003ea1980918872662c8e8f9be", "LGPL-2.1", "part 50", 85, 208, 208),
    ("6be95ca584d5f3c9443e6e6db8d9a636c3dea4d2336ffc5b433b61f2b679172e", "LGPL-2.1", "part 51", 85, 170, 170),
    ("17a697a5488dd693519513bc0beb535087567fd215e5b0c088ee0744ce336f06", "LGPL-2.1", "part 52", 85, 116, 116),
    ("ac8bbba8588aae299285c60cbbafe02f64c772c44cdac2a6346b5e0dae025ab1", "LGPL-2.1", "part 53", 85, 469, 469),
    ("91986c51411ac1c46cd5e1de92216542e2f7fefb401e4eebff372c11a83b5791", "LGPL-2.1", "part 54", 85, 269, 271),
    ("676f40ff34199fd74e972e9b0943d3afdcc168be109a0d0f8028770198858553", "LGPL-2.1", "part 55", 85, 384, 386),
    ("4387b3a84b6b6f7915c6ee30a0f02a13b5134c389422aee554b4f3a51738b783", "LGPL-2.1", "part 56", 85, 190, 190),
    ("886f2a656c203fe8e0e9aeaf780390ea37969fdf023e27ad495e3120d1d319ac", "LGPL-2.1", "part 57", 85, 187, 187),
    ("44ad0d26ecdbd4f9810c862bc751769781acc92d0023441f7136ca0612a7d044", "LGPL-2.1", "part 58", 85, 444, 456),
    ("25850e381f9e944ef892eb4bd0bf67ee75e2a1759452107e03436feaf759afce", "LGPL-2.1", "part 59", 85, 489, 495),
    ("0ab2aee6698ffe3a0f4a9d42105bcfb70ab4a5811d7887014fd44d2c21f65f35", "LGPL-2.1", "part 60", 85, 421, 425),
    ("b5ba0baad0e2eb1daf6ef7021d0955d10d9a6ba785620fe3fd0aa693f1da05ae", "LGPL-2.1", "part 61", 85, 789, 799),
    ("f3207b47b487e853abfca43d83ae4fe7af09efddab0dbfc566c547d2f05715ae", "LGPL-2.1", "part 62", 85, 216, 216),
    ("b37d69ead60104eb364fbf3e98df6b55fe5a7811155828427afc1dbd37c59961", "LGPL-2.1", "part 63", 85, 612, 614),
    ("1c7df6a7b7b0ab7404c8c4f6ee23d7da62c92f2a1fa87892bea27ce3263b4c8f", "LGPL-2.1", "part 64", 85, 114, 116),
    ("72363341dba43e00cef645cf13f0ad007ada49c47d691c8c9b94d041569e3753", "LGPL-2.1", "part 65", 85, 460, 466),
    ("efe254f491203d3833b3070f8eab776b4b3e757ad0f71f00bfbc11567be40d7f", "LGPL-2.1", "part 66", 85, 254, 256),
    ("ff71cb100cc18ec647c56f0aae11136ef8e31fa2baac63ead1012499733101fe", "LGPL-2.1", "part 67", 85, 431, 435),
    ("a18454e7545be7331be87940283fccbf822e59c5fade6f01341537e988913a47", "LGPL-2.1", "part 68", 85, 493, 493),
    ("5f948da1f3aee4c914e38c63bdd865e42ed584c41591abafc94b4cca5add969a", "LGPL-2.1", "part 69", 85, 11, 11),
    ("bca0cb858ea41e06f7b2fbcd8f2986dcd4aa7d27c4309103538885b8ac9bead2", "LGPL-2.1", "part 70", 85, 582, 582),
    ("5b40378b7726b95842868dc342c3b30eb6d283aa106d2ec38bb3fb89745a0af0", "LGPL-2.1", "part 71", 85, 603, 603),
    ("9f4a72c489c21471cc17ea0070937c5763a53121bbf0718a5749b8ef05435557", "LGPL-2.1", "part 72", 85, 27, 27),
    ("8a0fc1e79caf5ca913776439f8c6da9dcd59ceb1641138fd848bd5c037c39115", "LGPL-2.1", "part 73", 85, 46, 46),
    ("e7bc631f142e338a1bca3480599d079932cd389ba0f8d16d4f9b695fcbbe5732", "LGPL-2.1", "part 74", 85, 305, 307),
    ("38a9150239b9197c78e7c73b5a7a791ebe181a9af90a2dfa7e8e52ed85e28dbc", "LGPL-2.1", "part 75", 85, 280, 280),
    ("711e6b8bdcaaa926cfa3b6125f6b42a8f6f6798981a26358f13d915cbb0302dc", "LGPL-2.1", "part 76", 85, 68, 68),
    ("75b628aa9feebdcf605d36b772d64aa9bc4dc3e51668fd99e7df9478719f9aff", "LGPL-2.1", "part 77", 85, 237, 250),
    ("29ec30bf0b22bee9f2d303fb72e06a9824c52353301e2bdd31ab8de1b90fcba6", "LGPL-2.1", "part 78", 85, 235, 237),
    ("4b5c9dc7aa76f30d2caa3ff63d7731f5b1b91612a20d0fbe63dd847d7839de1b", "LGPL-2.1", "part 79", 85, 201, 203),
    ("08d075679ff0963d137622c6ec2e74bd9935d52fb8321c26b972d108f21a834e", "LGPL-2.1", "part 80", 85, 71, 71),
    ("95cef4f7d3c9c92dbd670ba7dd68c0df8b544ff47cec466cd23df760131c96bc", "LGPL-2.1", "part 81", 85, 176, 176),
    ("93e69e44fa77c3153cafc539b81d7459da9351f881654b42ebcab835a8b63eb8", "LGPL-2.1", "part 82", 85, 132, 132),
    ("6cf6fa34c8113bce9c9a5a9afc16d4cd4b5dee2699aa9277e89b2719aa72e1c2", "LGPL-2.1", "part 83", 85, 59, 59),
    ("b3143badf03a3c8ec5637ec52198279304a61d088617f093f4d8e74eff48aad3", "LGPL-2.1", "part 84", 85, 25, 25),
    ("aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be", "LGPL-3.0", "text", 37, 7076, 7162),
    ("b1dddaf7ef2e30067896bb2f11cf3c9defcf11564304f448a9257f49502a9e85", "LGPL-3.0", "part 0", 37, 49, 60),
    ("aaf9385eedc0e8797f25532c8f623c05bba02ebe7b124aefa1352367290a485a", "LGPL-3.0", "part 1", 37, 116, 118),
    ("5970fa0659dc97cf56a24259b94b6db0baa62cdee47d661ea0f04eb6faf1f411", "LGPL-3.0", "part 2", 37, 187, 200),
    ("7c381c3a725a12608a04939dfa0649dc4c48128dc6859fc496e3042b8ef00fec", "LGPL-3.0", "part 3", 37, 24, 24),
    ("01c5eebbce6d60cf5fa61238a97ff9d97a446dd450233b583116aa0685191535", "LGPL-3.0", "part 4", 37, 144, 168),
    ("671ebff08fefac21f28af4854f3b688b3dd7215d7fa63f3e5540d4695bca407b", "LGPL-3.0", "part 5", 37, 123, 125),
    ("c818feae5c80c052f5d133313a3acf5092bb6fba69670fe832fb60abe71d7ef1", "LGPL-3.0", "part 6", 37, 246, 246),
    ("74cdd819b81b1f0335db167ed9678869c58c1ceae94f12761c46fad324a1e086", "LGPL-3.0", "part 7", 37, 200, 200),
    ("7ab37d4c63c5f3a767057927f7774e7679756e9d8068d51ae5b7e077162f53b7", "LGPL-3.0", "part 8", 37, 253, 253),
    ("1ca2719c924a7f14fa5db77e2fe585af87dc9013fcc07e5e215d2edb38a1da10", "LGPL-3.0", "part 9", 37, 273, 273),
    ("150d8adfe1c86247ff224a1df77b78ebf19424258f9b0a1c9ae4a7065e9d5b12", "LGPL-3.0", "part 10", 37, 39, 39),
    ("064db1bbaf9e169d5f4bf6d1d02458b25345a5d14540a6bb9a0a7c1590c71898", "LGPL-3.0", "part 11", 37, 116, 118),
    ("e4f6b3f1e49fb6241e3f42d1e82991365a1db4a0249ed7d4ec8e1959eccf7870", "LGPL-3.0", "part 12", 37, 29, 29),
    ("59dd7d0706eec4cad66a293159fcda9e92e0243cb584533a3e8be2641986e375", "LGPL-3.0", "part 13", 37, 270, 270),
    ("10e4a8df1fa179d76e4fd1d02c7718a7b8a4f203f12e1a757ce6fd55b3b39347", "LGPL-3.0", "part 14", 37, 235, 237),
    ("d5aefdc989d93e28f7285a3353249a14caf882138b7174346f8a55101479ced4", "LGPL-3.0", "part 15", 37, 99, 101),
    ("01877aaa187a6c6c473e1846d4afc1e38f75aae28640c2c0bac2d7a6a6acd8d6", "LGPL-3.0", "part 16", 37, 62, 62),
    ("eb0ce365923cea370a3c53ce4a18f84f43bf7306d648e2e0c7418ebd9a0eb33d", "LGPL-3.0", "part 17", 37, 393, 393),
    ("5e11e4ba8a3985b05e0c761d8531af8065649396a17b3587d0c8ff448fd5a8fa", "LGPL-3.0", "part 18", 37, 149, 151),
    ("751b845af7e51e29bfbf53f4606095f5de0f7d78ad4d73594991a2ce5f956879", "LGPL-3.0", "part 19", 37, 80, 82),
    ("52298baee596396ce086a742623b165d88b53624272b7243a755ed48452226dc", "LGPL-3.0", "part 20", 37, 16, 16),
    ("9763f852c13d94ff5c72b49fb31824bba6dd08d2de2a7c1a07490350a05de2fc", "LGPL-3.0", "part 21", 37, 274, 274),
    ("7e1396f1f76dca5abb42d46c70e8a6c2ce4d6d85ad5af4ffa78a312d25a951e8", "LGPL-3.0", "part 22", 37, 151, 153),
    ("c8eeb0a2aca6f4480b7d68eaf091f8fdbd9ca06df0a6343af0ab3f618f61d708", "LGPL-3.0", "part 23", 37, 82, 84),
    ("e78ae662b52b0c4a8a28058322a808e361eb57867671aea766af4747726baa99", "LGPL-3.0", "part 24", 37, 232, 234),
    ("3e3be73a4b0f3888c22aef1d521ceec4b3f3967a16cefd6f06a0a04c329a5473", "LGPL-3.0", "part 25", 37, 25, 25),
    ("cfcca956e2b61d87d89680e3444211a808dc0142b398a915e066151deab7c5dd", "LGPL-3.0", "part 26", 37, 380, 382),
    ("5eef5ea3f95d46e0561a7ad629a7dad626ac2609f4a7592513376543d290ce4a", "LGPL-3.0", "part 27", 37, 310, 310),
    ("fcb2de215b897525993e7fb40a42291145dcfe8ec6e9dd2dca83770b5e5f8058", "LGPL-3.0", "part 28", 37, 646, 646),
    ("a71246f2f16d027f25f9e3acc801bf41af15d9f486646408fbd99e0ada65e7bc", "LGPL-3.0", "part 29", 37, 20, 20),
    ("b52c3ae7fb4ccd543a24b4906ffed682e9816f3dfaabb33a2199c7a60fe4a0f9", "LGPL-3.0", "part 30", 37, 297, 299),
    ("bd42dad5c30b835bd32827a6d6566878db3f4be90dc6d7995aa184425ccf6919", "LGPL-3.0", "part 31", 37, 168, 170),
    ("f44418ffc4071a8b1eb4860f1dceb45ba5ccdad495cee62e11cedb391dbb646b", "LGPL-3.0", "part 32", 37, 175, 175),
    ("8ab76054087ba61686a54e100f52291c21e8f81f60c7c65577d1ed7f8ddbf860", "LGPL-3.0", "part 33", 37, 59, 61),
    ("c5cd7709e49348df3949b0c9cb5d172ee5ae35bf1ddaa3acbd94177b88decdc3", "LGPL-3.0", "part 34", 37, 255, 257),
    ("dd152927268782bda642d42005e7139bc2dfb67f539f2638743668ff7bb02da0", "LGPL-3.0", "part 35", 37, 586, 592),
    ("fb31a8ea93295b990e0669f85c85de3df32d3dc6e6a1c320310093d606ba9366", "LGPL-3.0", "part 36", 37, 277, 279),
    ("b520e6536c3c98936bd84d6b28e6dd142e4cff8f36984afa377cf22d68178086", "MPL-1.1", "text", 73, 22325, 22515),
    ("e8d78c7ef0b7fb5f931ba9501977c8ca266cc1ab4b95b40fea21f3a7867310ca", "MPL-1.1", "part 0", 73, 34, 36),
    ("5e8200d69042fa63eaa665929691dfcc31c9c429a69a9c5659fdb8c74ff25e15", "MPL-1.1", "part 1", 73, 13, 13),
    ("784dea8d8b9daeeeba5cd79b5d96e1fd6d280392c4f8e862fb0805055629bc8e", "MPL-1.1", "part 2", 73, 103, 103),
    ("618e3c9e356b945714ad63d2c2110eb05cb19f08b11ca47dab3b2cc59916c47b", "MPL-1.1", "part 3", 73, 94, 94),
    ("5506b6ffaafd861be6474567fbbfab5e9dda7990e9cc315f5fc89d1e0417df7e", "MPL-1.1", "part 4", 73, 166, 166),
    ("c555d9756875f42b647f57760cf9844f1f85aef39cdf3b32211d3e916fefe152", "MPL-1.1", "part 5", 73, 155, 155),
    ("a83be976bb8ebf473ce18d8da0bb27bd0e82f1bbd3e80fd078cda68985e6904b", "MPL-1.1", "part 6", 73, 148, 148),
    ("70c8f00061a8322853389e5f0c5651e90da47532d6a4629f81047b8ba15b19ac", "MPL-1.1", "part 7", 73, 68, 68),
    ("a0db69e0debddb9b48c9c0321ea2a98b291f5487a8c86c7d66ea474f84e74d54", "MPL-1.1", "part 8", 73, 136, 136),
    ("d17c5832bf719ce60a11a86f14b35b4365a2db779641095f268f8c53cbbf5cb9", "MPL-1.1", "part 9", 73, 128, 130),
    ("b11defba38fb955434c1dd26cf88ece903baabc7c0548a27761d9af9a3d2e515", "MPL-1.1", "part 10", 73, 31, 33),
    ("caa317a10b906f38adef372b56458e83e0e28b296d1fb5839230b4647c252dfb", "MPL-1.1", "part 11", 73, 187, 187),
    ("549e880914ad177a0692347be826ca8fe05bff626ca915575d47e307b8018ea0", "MPL-1.1", "part 12", 73, 319, 319),
    ("92ec58b2c60eb8b233f36ba851b3911ce227f421eaf718cc7f819734e4b0ed12", "MPL-1.1", "part 13", 73, 84, 84),
    ("5cfb87db5d0e82bbf0bcc2c5ecf6c2af8f61ad1265565df4fb6cc811af686a91", "MPL-1.1", "part 14", 73, 255, 259),
    ("68b12b150fead6a4b41e216fc26671947c44033eb000773ef60ffbffbd70a383", "MPL-1.1", "part 15", 73, 178, 178),
    ("1c382a05abaee5251cc5bcb3c94d3f18c50d9f5108f98c3342936abbf9d2cec8", "MPL-1.1", "part 16", 73, 543, 543),
    ("fd1487e6e22805863752fde7a244b3d0133202e6c8bb308f31c2f0a15aee1172", "MPL-1.1", "part 17", 73, 574, 578),
    ("4cb1bc9a1690cefc70cc6bf3b79b11be84b29f7745c8c9681c7ddbc11ea22cd3", "MPL-1.1", "part 18", 73, 21, 23),
    ("4d3226e39b1ee881d782c95f20f919432cf8b59d181729deb1414aa3410a733b", "MPL-1.1", "part 19", 73, 441, 445),
    ("0658c2074d60a42481da4ab563613b7d6e65df73c783ed31b28277c842a2fb57", "MPL-1.1", "part 20", 73, 201, 201),
    ("fa7712d6f89f80c446fa3f94cef1633aeb6431bea368e54113329ba8661fc603", "MPL-1.1", "part 21", 73, 103, 105),
    ("bff9b417bdba878dbe0a4d9fa966f64c3a61887b21be8f67f362e320f788af86", "MPL-1.1", "part 22", 73, 297, 299),
    ("b15c522cf4da11b4ade4479c760f594ab6d0f685abfba60337d952ebc80e5b32", "MPL-1.1", "part 23", 73, 156, 158),
    ("b74e38dce60c6ae18cdc410ed58910123c9a7e1265bcb8c5f75bff1f4559ddfe", "MPL-1.1", "part 24", 73, 332, 334),
    ("d77cea491aebf6909c4cc22f527477bdacdcfc3f1030cefe2de198c83465c5e2", "MPL-1.1", "part 25", 73, 456, 456),
    ("e0d8e5a528bbb515808ccc7dc7196f36a59a8ca7a9cde97f3901710b412bae81", "MPL-1.1", "part 26", 73, 80, 80),
    ("069fc246ea8b54ca4e9d541c66ebf0d16f03fc904bd2159b074d53d5275746e9", "MPL-1.1", "part 27", 73, 499, 519),
    ("220196a52c16b030b3bcd67673a723eb4da626aaaf8d416bc04be72dd3808230", "MPL-1.1", "part 28", 73, 26, 26),
    ("067885076c8a654385d3395d23680e1473eb3dfda273e23c25f750cf03c18441", "MPL-1.1", "part 29", 73, 691, 703),
    ("2ce9481b0bb5c4e6217977ae699f8df65e0623992891c9fdf53464748f718787", "MPL-1.1", "part 30", 73, 770, 772),
    ("90b4b749b076c142a962d40cef7cb4f781795e53fa8cd5e67de270f53787db85", "MPL-1.1", "part 31", 73, 547, 547),
    ("cda48627661d080f4e28f5d1242db9e42c44b253509142604be95409299ab8bd", "MPL-1.1", "part 32", 73, 842, 844),
    ("ff95a4587f9e95cf9ba196cadb8adb43327b3157f805fb770edf04075f0b1a95", "MPL-1.1", "part 33", 73, 260, 262),
    ("390217f7298a3ebac7793f28401636e9055f7f4f00534b0e044ce3d7f82f7aa3", "MPL-1.1", "part 34", 73, 257, 259),
    ("941e37c93ccbe41c63176cfaf4d58397aca34a30be32a58f50051cc08e67b581", "MPL-1.1", "part 35", 73, 1194, 1196),
    ("dd466a2dd9e5ede668cce9c142b3fcf9410702f7a8bdebeb152264b15144952f", "MPL-1.1", "part 36", 73, 1386, 1402),
    ("21323d5f93a8603e12dc77bc4dff97f95cbe40c6e6446985c4bd399b1d1ca79a", "MPL-1.1", "part 37", 73, 282, 286),
    ("21a428cf27b6193aa098411f4105daffb9c214b40c2a5b922f2e7d8dc3c220e8", "MPL-1.1", "part 38", 73, 50, 50),
    ("28c8492c6558524812b9ce2b362036dd869bb78f71e02763b14fd3bbe361f6a1", "MPL-1.1", "part 39", 73, 614, 618),
    ("daeba77372bbdbd65a34dafadd38c20d48bc652b1346feb7c65541f79ef5e509", "MPL-1.1", "part 40", 73, 29, 31),
    ("c0f776ff6d46055e23ff05a3119605ac4fdfc587d3c1f64da918128d959ab57d", "MPL-1.1", "part 41", 73, 124, 126),
    ("dfdf88b6d074ae4f11399efdf8a686b7daab8631e34ea64e6de01fb509c363c4", "MPL-1.1", "part 42", 73, 25, 27),
    ("816aaf7ac0cad872d3f6067cc8f86503440b4fc03e243bd3e20878e449a3d580", "MPL-1.1", "part 43", 73, 193, 195),
    ("ecbd28fad7c006fe8465acecaf2aa3f5f8da56abf18574c5d4c290276dc73906", "MPL-1.1", "part 44", 73, 410, 416),
    ("e274b19df20ea43572c2a93536f4f0fc8578243e370b1550c933fd9c0c7f8221", "MPL-1.1", "part 45", 73, 733, 753),
    ("2dc9c6b1a99871129333bb40f63605d989b88ded90c7341bdd801235c33156d4", "MPL-1.1", "part 46", 73, 24, 24),
    ("1f8291b98743534777d0ec47ef69e890f88d98b17fe5d3d2046a9b1e88ae8ea6", "MPL-1.1", "part 47", 73, 669, 673),
    ("4e7f296565343f18ec0333d65b71e75a26b3e5cc834457d076f7b57ecb24929a", "MPL-1.1", "part 48", 73, 13, 13),
    ("b834c67d58a2858afebb72b03e1f3b80d03bac18d9823743efc3fe97d7ca5ecb", "MPL-1.1", "part 49", 73, 411, 417),
    ("c5ccb77f8b4c152c1d4848b7fc233e54da4c5e7f016238986ab7f2b9e6d3e257", "MPL-1.1", "part 50", 73, 266, 266),
    ("2b1cd3c7f6b88e66f1b9cb05667505561b3ce903cfb2c2d5284a3ab9e45b1ad4", "MPL-1.1", "part 51", 73, 893, 895),
    ("09914ade7aceb413b180f8f4b8b6c4d89832a0913b41f3b2abb6274653824f90", "MPL-1.1", "part 52", 73, 334, 334),
    ("4bff01a6aa0225ee03c42d248c7db995995bd41affaa394ae6d2c1b66bbe22ef", "MPL-1.1", "part 53", 73, 466, 472),
    ("0d148a33e9d4b06d8a5e0d6bf8726aec2235a52ec9e460c0e4708ce899196278", "MPL-1.1", "part 54", 73, 247, 249),
    ("c13ab2a47b052077fed07131395169511ad589c62c2721e47a434e60cb49cf8d", "MPL-1.1", "part 55", 73, 25, 25),
    ("04cbfb77fcba3c3caa131ba2c3f40b66948fde18e0ed64ae72b4c48420434d2e", "MPL-1.1", "part 56", 73, 901, 901),
    ("794fd5eb1c2ca7c9bc587364e66fab5f0fece4051a290be588a40b80f1eb8f9b", "MPL-1.1", "part 57", 73, 27, 27),
    ("7e5865bd09b77f8111c296cb980e109879a6e9a4b5f4903651fe988c6a5fba97", "MPL-1.1", "part 58", 73, 405, 405),
    ("cb1343657908fdd008c30532630a3861af6c2b5c24444ecdd15fa9e826ba4049", "MPL-1.1", "part 59", 73, 16, 16),
    ("42498ceb64f2e4fc1d8a7f145f4419a28340cf8acb694b0a184a09d5a3037080", "MPL-1.1", "part 60", 73, 1117, 1127),
    ("cad76e323a36469fd9e57f08ade6a628ddc2f3a8dbb8c32734198147e349c909", "MPL-1.1", "part 61", 73, 28, 28),
    ("743f958295e7a4736f48b071e1107e170bfdc3fc40ba732dcb3759e4a443e6cb", "MPL-1.1", "part 62", 73, 386, 388),
    ("668a320b3a0904528e206a818440ba0abd2ce0c7e02d352e3626fa64dcf40739", "MPL-1.1", "part 63", 73, 25, 25),
    ("7c2ed607bfc3d1b60f6c4fb3ef03be040e9bbe88446db2bde96a85d50c653142", "MPL-1.1", "part 64", 73, 317, 319),
    ("56b924e57290be6913b837aef9b40b4361434345df350fc8766a34843426a5eb", "MPL-1.1", "part 65", 73, 32, 34),
    ("cda46464ada5bf296c258171863c8900fbf73cdbf03c8af9f70569dcde0983b7", "MPL-1.1", "part 66", 73, 221, 229),
    ("3d31d9444dc03408ed458350aed4e15e992f9f0e44351ced6dd82728ae8de191", "MPL-1.1", "part 67", 73, 219, 225),
    ("52b9b9b0cd2eb7ae932e72a36506acd299b6aae0e6c5a8b099c9d2068cf88884", "MPL-1.1", "part 68", 73, 20, 20),
    ("314e83ae5b4703d8381f1a943c7c0f135eaeb2b1ded527d91b80f2f9b5efedbe", "MPL-1.1", "part 69", 73, 101, 101),
    ("a23e17a2b1aa1ead39208707995f4a8e0ff392a1c4db28a6c281ddce40b2f52e", "MPL-1.1", "part 70", 73, 13, 13),
    ("fef9a27180aedee977e1d587b70a6998967c3da4bdde53acdfb3c39e05092c10", "MPL-1.1", "part 71", 73, 591, 603),
    ("b0dc50976a6d7e1e3ed1c08b47cb0de77906755978c35089c0166fbc377d0ec6", "MPL-1.1", "part 72", 73, 251, 251),
    ("2b5510cdc73b81225fe3be7ad97d919fbbeb60faaf6ca7fe82f82254db44d516", "MPL-2.0", "text", 83, 14223, 14452),
    ("58c9a1c62b739e4bead89c80c6af62cd77999c648016e24ba011e53180a5cc15", "MPL-2.0", "part 0", 83, 27, 38),
    ("5e8200d69042fa63eaa665929691dfcc31c9c429a69a9c5659fdb8c74ff25e15", "MPL-2.0", "part 1", 83, 13, 13),
    ("7b42c8b5b9d1c573949495225fa2e38cd985eb24c3932e211637a65093b2db7a", "MPL-2.0", "part 2", 83, 122, 122),
    ("f014d570487ba4346b67a1f85051209835ae63ff0cebd120c94c3d8ad7abd479", "MPL-2.0", "part 3", 83, 152, 152),
    ("20c69f56f0dadf10ae9284771797b361bb450fa8692e0232537eae3c9afa5739", "MPL-2.0", "part 4", 83, 67, 67),
    ("a8751b95e00087126abc5fced2428e72358bc3a694dcec3c57d7c18144024b22", "MPL-2.0", "part 5", 83, 241, 241),
    ("614366b925fa09e48b9fb2f3d41318bccecda6128b7bf3dfce8dd6cea5dddec2", "MPL-2.0", "part 6", 83, 45, 47),
    ("8f65e5dbd070eac929367d3089734342b03a00b7a6e329c6e74a7d97c84874f0", "MPL-2.0", "part 7", 83, 104, 104),
    ("4b3d853a18d78fc601eae2a1580c018ea938a92b705dd2c87bf4edf235d2dd68", "MPL-2.0", "part 8", 83, 155, 159),
    ("9c452d40de639a5ecead8100e34db38b1579668b175938c45d258666a5963393", "MPL-2.0", "part 9", 83, 74, 74),
    ("80174f8aae33caabf3376bfb8368b010c0e1963f9d94d7ba0914a2694f03c7bd", "MPL-2.0", "part 10", 83, 136, 136),
    ("b11defba38fb955434c1dd26cf88ece903baabc7c0548a27761d9af9a3d2e515", "MPL-2.0", "part 11", 83, 31, 33),
    ("cc8da02c772e29d8ecf0138324f67d5c77aa06278b00a193bb1f064f4deb9c76", "MPL-2.0", "part 12", 83, 185, 187),
    ("d55bcaa726c3bb3f4325d5b387917d4138e51eb31e16eaed0af0e06cc228262e", "MPL-2.0", "part 13", 83, 45, 45),
    ("1971f834cdb3ecf162a2dfa9fb8d0a70e59de40febe58d675fa5f1a477be6a6e", "MPL-2.0", "part 14", 83, 132, 132),
    ("9cfd6507a1093c7235580f4c4fc8fef5703f9d45df944307ca287fc27c7e6550", "MPL-2.0", "part 15", 83, 69, 69),
    ("6e172c0cc78347962ddcc2b8caec9a3b7bb5351b6fae5b196b6646928c41dbe4", "MPL-2.0", "part 16", 83, 359, 361),
    ("f35d8c6ec86927294862509c95d058f973f84e21a510c90b0cbe176dc7333b3b", "MPL-2.0", "part 17", 83, 196, 233),
    ("2069e4b053691522805a12f5080af83863ab5e826d2b530be16bbf9b335180c7", "MPL-2.0", "part 18", 83, 83, 83),
    ("4f26bea4b89e173d146115dda87694ce645425d672d04b2a6fb986132e5cb53b", "MPL-2.0", "part 19", 83, 473, 475),
    ("3f0889ed22d558249007dc260aa8eff200876929b17a00db1b7d2f8364eae28e", "MPL-2.0", "part 20", 83, 31, 33),
    ("9ead65c0ea11ba33c3944ce70b95d0f6826f47a7d5e13b812738b64e201a90bf", "MPL-2.0", "part 21", 83, 10, 10),
    ("bdd42de1c9cb2cec120d10b6bc4d8ad21e47a5faa4771a666b7cb8ca8005f3df", "MPL-2.0", "part 22", 83, 82, 84),
    ("104fe6d9b7e0b3cdb15ba7db490b30a4cff0f63943797e45d90ecc16e572367a", "MPL-2.0", "part 23", 83, 285, 285),
    ("418960bc8a1e120a59d2e000fa212ab0c85af7ec021403e2cd5116de755caca7", "MPL-2.0", "part 24", 83, 165, 165),
    ("e258d415c9b0ee22522eaf9cb1c85e303c72024042498b600b130498a9a3079a", "MPL-2.0", "part 25", 83, 18, 18),
    ("941d9c57db129971223f4c034495fb60c3e0637b9758314df38f71b92736f268", "MPL-2.0", "part 26", 83, 170, 172),
    ("1273d50d9648f2ee371e48239d51841554d91841d81cd16e3c1ccb54c32570c8", "MPL-2.0", "part 27", 83, 30, 30),
    ("fe10b9dbc14dd25c8931e42f03887839f4155fe6b7838168f91e011f1d87925e", "MPL-2.0", "part 28", 83, 288, 298),
    ("749daccd49e8ff835bc1d9acc654d26da94e2c7888a1606c6ec84498d5f729eb", "MPL-2.0", "part 29", 83, 70, 70),
    ("043a6c4738b83deac4883154be7fc7ce6599324f059584be2c9b535f1e19d4fd", "MPL-2.0", "part 30", 83, 206, 206),
    ("7e6595ad7f588e9ff45629d75dc8127203ac67521c667be03715b41e183165db", "MPL-2.0", "part 31", 83, 17, 17),
    ("db06d2e3ad193fbc2d63a8202346b36cf7c2533b6b78f1dd29c944d0a33dad86", "MPL-2.0", "part 32", 83, 179, 181),
    ("6d726609e6abdf4e3d23fc2e61328f2c1be27de0f41ea8b5d42d45384cbd2a56", "MPL-2.0", "part 33", 83, 22, 24),
    ("fd8bf500616ff99ba3a535cd6c575dbd179d24d56526ddb775e94e45ef3f36ba", "MPL-2.0", "part 34", 83, 246, 250),
    ("5e2c2aa6ffe091581037bce351afae203b648db69895762a1fe0d715bb52df5c", "MPL-2.0", "part 35", 83, 18, 18),
    ("d4b4ae65ca68cc2efe93045b8ffb77c3b9b9f7194585575370747b2e1c36ad05", "MPL-2.0", "part 36", 83, 197, 199),
    ("c7427dbcc411bba8f445320f5f055c4a7f8f039983d305a980875427dc72268d", "MPL-2.0", "part 37", 83, 12, 12),
    ("d5ac3fc193be61e9771f81129798267bcce99962b2c7f03575930c91ac2927bf", "MPL-2.0", "part 38", 83, 140, 142),
    ("fd81f9b42e925fa529b6560f8765718a9bac60db6aeca1c3ba29ff90e916adc1", "MPL-2.0", "part 39", 83, 14, 14),
    ("62ac1712f47517db62c8a2dcc96238efc9b9b74d20c033d5d3a947d9017ff1ac", "MPL-2.0", "part 40", 83, 81, 83),
    ("aea33a373b802cb5eaf007db6ca884363558b39f9e8bd8371c03f58030c29ed0", "MPL-2.0", "part 41", 83, 18, 18),
    ("c998dea6bccc5a11147fa7df887546cae3769addaf0f66ff5acf1f3fd4af94ed", "MPL-2.0", "part 42", 83, 31, 31),
    ("c05cc3ad5a39edae52d84b7bdac386245196d84d4931e63de8f1506a988b77d8", "MPL-2.0", "part 43", 83, 419, 425),
    ("4e94008c5b2c38aaf6662660cf34088caab06d616a9b5050f806dac5f82cd45a", "MPL-2.0", "part 44", 83, 35, 35),
    ("799682e3ebe69aca86857ca057656a07792fa1a4b56e037d985ffd7801039fc4", "MPL-2.0", "part 45", 83, 58, 58),
    ("192cd0dec764b254362eb3c4d2704f865660d81635718a7982964fc7d728ad1e", "MPL-2.0", "part 46", 83, 315, 315),
    ("4384b35512a1b25f0d17752b2a2adf5063706ed16f64d1620668b056988af44d", "MPL-2.0", "part 47", 83, 262, 270),
    ("91d15e1cb2164b58386babe2cf6ef280aed6dcf3ce0e2f1efb8adfbb70118367", "MPL-2.0", "part 48", 83, 33, 33),
    ("4b1ccf0fcb0945c8dc3f718e07cb51d408ca9d6521b58337e11088f56f07a07d", "MPL-2.0", "part 49", 83, 627, 641),
    ("495bf8454810af799e628e0307dffbaec9ef9d43fd47f1acb8ba524547d29312", "MPL-2.0", "part 50", 83, 11, 11),
    ("5f139a4892ce1d9ebec9505783570a34dcea876b35a140d7809f24c9d8c29341", "MPL-2.0", "part 51", 83, 327, 331),
    ("35da3b0833da2e56d50755767cf677d95aadcfcb945ad0d55f61f7bdce03bd21", "MPL-2.0", "part 52", 83, 35, 35),
    ("11ab4afe25ec76ce87dd8c738592d2d8667b9e62f1262f15e17cdf7eaf60d59a", "MPL-2.0", "part 53", 83, 630, 630),
    ("21a428cf27b6193aa098411f4105daffb9c214b40c2a5b922f2e7d8dc3c220e8", "MPL-2.0", "part 54", 83, 50, 50),
    ("b0b5adcba8c68c6d33ffe03bd3be4930d5e209700d1f04c524ee8f72c6ebac2b", "MPL-2.0", "part 55", 83, 600, 606),
    ("86a94b220881fb6de5ee91a6ad58af6f0398831e75c168567c86ebb7cb052a79", "MPL-2.0", "part 56", 83, 13, 13),
    ("f7a1b562445b4ac915a48d996299fdb1491512de7c7b6c7cbf4b35415f72e372", "MPL-2.0", "part 57", 83, 848, 854),
    ("2744fc433cef54f785cad43036792812b782d735481e5c2ef47e50a1b6570493", "MPL-2.0", "part 58", 83, 375, 377),
    ("98364e493d46403ef9ed3e1ddebe29837875a4b07149de3c1aef0af0b760d928", "MPL-2.0", "part 59", 83, 258, 262),
    ("f2bc7eb7bf74c03d3d402e9b1b03b695c1e2913625b97b1d2663c8738eddb9e6", "MPL-2.0", "part 60", 83, 24, 24),
    ("a3c8a93fbab4c5dae46b6b8598cf2f966a0f8616655c824354a88cd4c0ac8416", "MPL-2.0", "part 61", 83, 677, 683),
    ("3ba957a8b9b1802854eb96291ebaab0a7229c5a10c5206b503d52c0c9fa65678", "MPL-2.0", "part 62", 83, 25, 25),
    ("095412a22594f4c1eebb6b8f19eb6b986bf67539ba0ba8c5f890c023673b33f7", "MPL-2.0", "part 63", 83, 870, 870),
    ("334cb8531cd6729e4f59c2cc3f6c8cc1f1169fa2054c7d33c698bbf255cb0041", "MPL-2.0", "part 64", 83, 12, 12),
    ("c2653effbeec6e8c5a3dcd51719adbca28773d25f4e481adfa7554b42d91c680", "MPL-2.0", "part 65", 83, 368, 370),
    ("a7896f645dd926027dba99b9276b819fcc0b2fe44d5a062a10b783fc00fb1632", "MPL-2.0", "part 66", 83, 15, 15),
    ("2a82dcf2744321bc9352465d71fe4bfbdbd25a73fc4d10bf94c56b19f46f3aab", "MPL-2.0", "part 67", 83, 402, 408),
    ("bf37086512af4427dc36a691f2aeeb43a845063e09591a4f1bb64d6e80eb5d0b", "MPL-2.0", "part 68", 83, 26, 28),
    ("c0973bb80dc0d7b340aec8baf2a22fd3aae1efe6407579c63b412ca2d2327517", "MPL-2.0", "part 69", 83, 17, 17),
    ("860898d75d073ebde23a1081677e340dd94b24ab9465721f018f73c921454489", "MPL-2.0", "part 70", 83, 237, 243),
    ("41f853316845c771e7c187cc227976caf616fa04be8b6739ba9c183dfd7ed165", "MPL-2.0", "part 71", 83, 27, 27),
    ("640a9cc165bd0ccf699a332dce068e02a296ddedf88c47d69be3acfef30fd95e", "MPL-2.0", "part 72", 83, 220, 224),
    ("0f9de007dfaebc175960bd81c05652e41f87adc60773b395a37be71bebde21a5", "MPL-2.0", "part 73", 83, 22, 22),
    ("2b22b24db09f15d0e0bb76dc5e22578f004e8b1f4b332f944725af65409d4776", "MPL-2.0", "part 74", 83, 319, 333),
    ("82b0613add973646b790ed3bb651228e599f2e0171abc17ca1d36f56c8f5d56a", "MPL-2.0", "part 75", 83, 78, 80),
    ("b8bc33551d462b10c6cffd259413bd0f7088262acfedf8853d1bdc7f036ebbf5", "MPL-2.0", "part 76", 83, 202, 208),
    ("91e64be38e924303427cb9de1b02fa0a80cdada5c1498a1a0441dc765dc7a39e", "MPL-2.0", "part 77", 83, 41, 43),
    ("6d764889ca49f5fae4cb860d8babd1f4af250b5c7e6ad71490a24cc0c5922ed8", "MPL-2.0", "part 78", 83, 183, 194),
    ("7997a07e22bbab736bdf9a38b53baf2c2366519f3f85b8554c6ed2990bcc7379", "MPL-2.0", "part 79", 83, 226, 228),
    ("721edf1c071ab58cf64eed933b3d5d00202aa7b926a2f109cde8d3f5a23a2d54", "MPL-2.0", "part 80", 83, 62, 62),
    ("9c26da907150501e8c033e8b73c6430bfc12701fb001ffe916ace9d6fe2b859e", "MPL-2.0", "part 81", 83, 52, 54),
    ("b421f6b3e504aacbf822eb5f14b699ff82fd3512b88d05370d4205e67df1b425", "MPL-2.0", "part 82", 83, 106, 119),
    ("e2380bdfe57ca73b01d0b1848a4ee630998d729b260e63082b9267100b4a7229", "Unlicense", "text", 5, 1170, 1172),
    ("c933e7afa5abf4f2ac1fe841a7716f9501b9882b5a4565611f8e066d58c9470c", "Unlicense", "part 0", 5, 70, 70),
    ("86425c1b28046c583de43f7939b7bd7a49ff0b3d1b7d829d5c5f6ddd27fbe4d4", "Unlicense", "part 1", 5, 194, 196),
    ("c03063205e4f8aeb61e32dc5dc77dd00b903693feda3a3aafa2fcebc5b6c9a97", "Unlicense", "part 2", 5, 421, 421),
    ("b3949084272289202ff03de05a8c7fc5a4acbb52b68ff09fb27f819964ef7aaa", "Unlicense", "part 3", 5, 426, 426),
    ("c4483b51fd3bd4ea8e24e6e91bb69f8d41adc0fb49dc903eeae25d0d54071ffa", "Unlicense", "part 4", 5, 55, 55),
]
