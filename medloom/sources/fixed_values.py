"""Lookup values every report shares. They must equal the programme's own tables."""

# Regimen catalogue.
# reg_id | name | drug 1 | drug 2 | drug 3 (0 = none) | short name | group
REGIMENS = """
1 | 1stReg1 | 84309 | 78643 | 80586 | d4T-3TC-NVP | 1stReg1
2 | 1stReg2 | 84309 | 78643 | 75523 | d4T-3TC-EFV | 1stReg2
3 | 1stReg3a | 86663 | 78643 | 80586 | ZDV-3TC-NVP | 1stReg3
5 | 1stReg4a | 86663 | 78643 | 75523 | ZDV-3TC-EFV | 1stReg4
7 | 2ndAdult1 | 86663 | 74807 | 794 | ZDV-ddI-LPV/r | 2ndAdult1
8 | 2ndAdult2 | 84309 | 74807 | 794 | d4T-ddI-LPV/r | 2ndAdult2
9 | 2ndChild1 | 84309 | 74807 | 80487 | d4T-ddI-NFV | 2ndChild1
10 | 1stReg8a | 817 | 0 | 0 | ZDV-3TC-ABC | 1stReg8
11 | 2ndAdult3 | 86663 | 74807 | 77995 | ZDV-ddI-IDV | 2ndAdult3
12 | 2ndAdult4 | 86663 | 74807 | 80487 | ZDV-ddI-NFV | 2ndAdult4
13 | 1stReg7 | 84795 | 75628 | 75523 | FTC-TNF-EFV | 1stReg7
14 | 1stReg8b | 86663 | 78643 | 70056 | ZDV-3TC-ABC | 1stReg8
15 | 1stReg8c | 630 | 70056 | 0 | ZDV-3TC-ABC | 1stReg8
16 | 1stReg9 | 70056 | 74807 | 75628 | ABC-ddI-FTC | 1stReg9
17 | 1stReg10 | 70056 | 74807 | 78643 | ABC-ddI-3TC | 1stReg10
18 | 1stReg11 | 70056 | 74807 | 84309 | ABC-ddI-d4T | 1stReg11
19 | 1stReg12 | 70056 | 74807 | 86663 | ABC-ddI-ZDV | 1stReg12
20 | 1stReg13 | 70056 | 74807 | 84795 | ABC-ddI-TNF | 1stReg13
21 | 1stReg14 | 70056 | 74807 | 75523 | ABC-ddI-EFV | 1stReg14
22 | 1stReg15 | 70056 | 74807 | 80586 | ABC-ddI-NVP | 1stReg15
23 | 1stReg16 | 70056 | 75628 | 78643 | ABC-FTC-3TC | 1stReg16
24 | 1stReg17 | 70056 | 75628 | 84309 | ABC-FTC-d4T | 1stReg17
25 | 1stReg18 | 70056 | 75628 | 84795 | ABC-FTC-TNF | 1stReg18
26 | 1stReg19 | 70056 | 75628 | 86663 | ABC-FTC-ZDV | 1stReg19
27 | 1stReg20 | 70056 | 75628 | 75523 | ABC-FTC-EFV | 1stReg20
28 | 1stReg21 | 70056 | 75628 | 80586 | ABC-FTC-NVP | 1stReg21
29 | 1stReg22 | 70056 | 78643 | 84309 | ABC-3TC-d4T | 1stReg22
30 | 1stReg23 | 70056 | 78643 | 84795 | ABC-3TC-TNF | 1stReg23
31 | 1stReg24 | 70056 | 78643 | 75523 | ABC-3TC-EFV | 1stReg24
32 | 1stReg25 | 70056 | 78643 | 80586 | ABC-3TC-NVP | 1stReg25
33 | 1stReg26 | 70056 | 84309 | 84795 | ABC-d4T-TNF | 1stReg26
34 | 1stReg27 | 70056 | 84309 | 86663 | ABC-d4T-ZDV | 1stReg27
35 | 1stReg28 | 70056 | 84309 | 75523 | ABC-d4T-EFV | 1stReg28
36 | 1stReg29 | 70056 | 84309 | 80586 | ABC-d4T-NVP | 1stReg29
37 | 1stReg30 | 70056 | 84795 | 86663 | ABC-TNF-ZDV | 1stReg30
38 | 1stReg31 | 70056 | 84795 | 75523 | ABC-TNF-EFV | 1stReg31
39 | 1stReg32 | 70056 | 84795 | 80586 | ABC-TNF-NVP | 1stReg32
40 | 1stReg33 | 70056 | 86663 | 75523 | ABC-ZDV-EFV | 1stReg33
41 | 1stReg34 | 70056 | 86663 | 80586 | ABC-ZDV-NVP | 1stReg34
42 | 1stReg35a | 86663 | 78643 | 74807 | ZDV-3TC-ddI | 1stReg35
43 | 1stReg36a | 86663 | 78643 | 75628 | ZDV-3TC-FTC | 1stReg36
44 | 1stReg37a | 86663 | 78643 | 84309 | ZDV-3TC-d4T | 1stReg37
45 | 1stReg38a | 86663 | 78643 | 84795 | ZDV-3TC-TNF | 1stReg38
46 | 1stReg39 | 74807 | 75628 | 78643 | ddI-FTC-3TC | 1stReg39
47 | 1stReg40 | 74807 | 75628 | 84309 | ddI-FTC-d4T | 1stReg40
48 | 1stReg41 | 74807 | 75628 | 84795 | ddI-FTC-TNF | 1stReg41
49 | 1stReg42 | 74807 | 75628 | 86663 | ddI-FTC-ZDV | 1stReg42
50 | 1stReg43 | 74807 | 75628 | 75523 | ddI-FTC-EFV | 1stReg43
51 | 1stReg44 | 74807 | 75628 | 80586 | ddI-FTC-NVP | 1stReg44
52 | 1stReg45 | 74807 | 78643 | 84309 | ddI-3TC-d4T | 1stReg45
53 | 1stReg46 | 74807 | 78643 | 84795 | ddI-3TC-TNF | 1stReg46
55 | 1stReg48 | 74807 | 78643 | 75523 | ddI-3TC-EFV | 1stReg48
56 | 1stReg49 | 74807 | 78643 | 80586 | ddI-3TC-NVP | 1stReg49
57 | 1stReg50 | 74807 | 84309 | 84795 | ddI-d4T-TNF | 1stReg50
58 | 1stReg51 | 74807 | 84309 | 86663 | ddI-d4T-ZDV | 1stReg51
59 | 1stReg52 | 74807 | 84309 | 75523 | ddI-d4T-EFV | 1stReg52
60 | 1stReg53 | 74807 | 84309 | 80586 | ddI-d4T-NVP | 1stReg53
61 | 1stReg54 | 74807 | 84795 | 86663 | ddI-TNF-ZDV | 1stReg54
62 | 1stReg55 | 74807 | 84795 | 75523 | ddI-TNF-EFV | 1stReg55
63 | 1stReg56 | 74807 | 84795 | 80586 | ddI-TNF-NVP | 1stReg56
64 | 1stReg57 | 74807 | 86663 | 75523 | ddI-ZDV-EFV | 1stReg57
65 | 1stReg58 | 74807 | 86663 | 80586 | ddI-ZDV-NVP | 1stReg58
66 | 1stReg59 | 75628 | 78643 | 84309 | FTC-3TC-d4T | 1stReg59
67 | 1stReg60 | 75628 | 78643 | 84795 | FTC-3TC-TNF | 1stReg60
69 | 1stReg62 | 75628 | 78643 | 75523 | FTC-3TC-EFV | 1stReg62
70 | 1stReg63 | 75628 | 78643 | 80586 | FTC-3TC-NVP | 1stReg63
71 | 1stReg64 | 75628 | 84309 | 84795 | FTC-d4T-TNF | 1stReg64
72 | 1stReg65 | 75628 | 84309 | 86663 | FTC-d4T-ZDV | 1stReg65
73 | 1stReg66 | 75628 | 84309 | 75523 | FTC-d4T-EFV | 1stReg66
74 | 1stReg67 | 75628 | 84309 | 80586 | FTC-d4T-NVP | 1stReg67
75 | 1stReg68 | 75628 | 84795 | 86663 | FTC-TNF-ZDV | 1stReg68
76 | 1stReg69 | 75628 | 84795 | 80586 | FTC-TNF-NVP | 1stReg69
77 | 1stReg70 | 75628 | 86663 | 75523 | FTC-ZDV-EFV | 1stReg70
78 | 1stReg71 | 75628 | 86663 | 80586 | FTC-ZDV-NVP | 1stReg71
79 | 1stReg72 | 78643 | 84309 | 84795 | 3TC-d4T-TNF | 1stReg72
80 | 1stReg73 | 78643 | 84795 | 75523 | 3TC-TNF-EFV | 1stReg73
81 | 1stReg74 | 78643 | 84795 | 80586 | 3TC-TNF-NVP | 1stReg74
82 | 1stReg75 | 84309 | 84795 | 86663 | d4T-TNF-ZDV | 1stReg75
83 | 1stReg76 | 84309 | 84795 | 75523 | d4T-TNF-EFV | 1stReg76
84 | 1stReg77 | 84309 | 84795 | 80586 | d4T-TNF-NVP | 1stReg77
85 | 1stReg78 | 84309 | 86663 | 75523 | d4T-ZDV-EFV | 1stReg78
86 | 1stReg79 | 84309 | 86663 | 80586 | d4T-ZDV-NVP | 1stReg79
87 | 1stReg80 | 84795 | 86663 | 75523 | TNF-ZDV-EFV | 1stReg80
88 | 1stReg81 | 84795 | 86663 | 80586 | TNF-ZDV-NVP | 1stReg81
89 | 2ndReg4 | 84795 | 75628 | 794 | TNF-FTC-LPV/r | 2ndReg4
90 | 2ndReg5a | 86663 | 78643 | 794 | ZDV-3TC-LPV/r | 2ndReg5
93 | 2ndReg8 | 84309 | 78643 | 77995 | d4T-3TC-IDV | 2ndReg8
94 | 2ndReg9 | 84309 | 78643 | 794 | d4T-3TC-LPV/r | 2ndReg9
95 | 2ndReg10 | 84309 | 78643 | 80487 | d4T-3TC-NFV | 2ndReg10
96 | 2ndReg11 | 84309 | 74807 | 77995 | d4T-ddI-IDV | 2ndReg11
98 | 2ndReg13a | 86663 | 78643 | 77995 | ZDV-3TC-IDV | 2ndReg13
99 | 2ndReg13b | 630 | 77995 | 0 | ZDV-3TC-IDV | 2ndReg13
54 | 1stReg35b | 630 | 74807 | 0 | ZDV-3TC-ddI | 1stReg35
68 | 1stReg36b | 630 | 75628 | 0 | ZDV-3TC-FTC | 1stReg36
91 | 1stReg37b | 630 | 84309 | 0 | ZDV-3TC-d4T | 1stReg37
92 | 1stReg38b | 630 | 84795 | 0 | ZDV-3TC-TNF | 1stReg38
97 | 2ndReg5b | 630 | 794 | 0 | ZDV-3TC-LPV/r | 2ndReg5
100 | 2nd2009-1 | 84795 | 78643 | 159809 | TNF-3TC-ATV/r | 2nd2009-1
101 | 2nd2009-2 | 84795 | 78643 | 794 | TNF-3TC-LPV/r | 2nd2009-2
102 | 2nd2009-3 | 84795 | 75628 | 159809 | TNF-FTC-ATV/r | 2nd2009-3
103 | 2nd2009-5 | 630 | 159809 | 0 | AZT-3TC-ATV/r | 2nd2009-5
104 | 2nd2009-5 | 86663 | 78643 | 159809 | AZT-3TC-ATV/r | 2nd2009-5
105 | 2nd2009-10 | 630 | 84795 | 159809 | AZT-TNF-3TC-ATV/r | 2nd2009-10
106 | 2nd2009-12 | 630 | 84795 | 794 | AZT-TNF-3TC-LPV/r | 2nd2009-12
107 | 2nd2016-1 | 84795 | 75628 | 74258 | TNF+FTC+DRV/r | 2nd2016-1
108 | 1stReg2016-2 | 630 | 80586 | 0 | AZT+3TC+NVP | 1stReg2016
109 | 2nd2016-3 | 84795 | 78643 | 74258 | TNF+3TC+DRV/r | 2nd2016-3
110 | 2nd2016-4 | 630 | 74258 | 0 | AZT+3TC+DRV/r | 2nd2016-4
111 | 2nd2016-5 | 630 | 794 | 0 | AZT+3TC+LPR/r | 2nd2016-5
112 | 1stReg2016-6 | 630 | 75523 | 0 | AZT+3TC+EFV | 1stReg2016
113 | 1stReg2016-7 | 70056 | 86663 | 78643 | ABC + AZT+3TC | 1stReg2016
114 | 2nd2016-8 | 74258 | 75523 | 154378 | DRV/r+EFV+RAL | 2nd2016-8
115 | 2nd | 70056 | 78643 | 794 | ABC-3TC-LPV/r | 2nd
116 | 2nd | 70056 | 78643 | 159809 | ABC-3TC-ATV/r | 2nd
117 | 1stReg | 84795 | 78643 | 165085 | TNF-3TC-DTG | 1stReg
118 | 2nd | 70056 | 78643 | 74258 | ABC-3TC-DRV/r | 1stReg
119 | 3rd | 74258 | 165085 | 159810 | DRV-DTG-ETV | 3rd
120 | 1stReg | 630 | 165085 | 0 | AZT-3TC-DTG | 1stReg
121 | 1stReg | 70056 | 78643 | 165085 | ABC-3TC-DTG | 1stReg
122 | 1stReg127 | 70056 | 78643 | 154378 | ABC+3TC+RAL | 1stReg127
123 | 1stReg128 | 630 | 154378 | 0 | AZT+3TC+RAL | 1stReg128
124 | 1stReg129 | 86663 | 78643 | 154378 | AZT+3TC+RAL | 1stReg129
"""

# Drug catalogue.
# lookup id | drug number | concept id (empty = none) | name | label | group | standard dose | short name
DRUGS = """
1 | 1 | 70056 | abacavir | Abacavir (ABC) | NRTIs | 300mg BID | ABC
2 | 2 | 70245 | acyclovir | Acyclovir | Other Treatments |  | 
3 | 3 |  | amprenavir | Amprenavir (AMP) | Pls | 1200mg BID | AMP
4 | 4 |  | amprenavirPlusBostRtv | Amprenavir+BostRTV | Pls | 1200mg/200mg qd | AMP+BostRTV
5 | 5 | 71647 | atazanavir | Atazanavir (ATZN) | Pls | 400mg qd | ATZN
6 | 6 | 159809 | atazanavirPlusBostRtv | Atazanavir+BostRTV | Pls | 300mg/100mg qd | ATZN+BostRTV
7 | 7 |  | capravirine | Capravirine (CPV) | NNRTIs | 1400mg BID | CPV
8 | 8 | 630 | combivir | Combivir (AZT+3TC) | NRTIs | 300mg/150mg BID | AZT+3TC
9 | 9 | 105281 | cotrimoxazole | Cotrimoxazole (TMS) | Antibiotic |  | TMS
10 | 10 | 74807 | didanosine | Didanosine (ddI) | NRTIs | EC 400mg qd | ddI
11 | 11 | 75523 | efavirenz | Efavirenz (EFV) | NNRTIs | 600mg qd | EFV
12 | 12 | 75628 | emtricitabine | Emtricitabine (FTC) | NRTIs | 200mg qd | FTC
13 | 13 | 75948 | ethambutol | Ethambutol | Anti-TB |  | 
14 | 14 | 76488 | fluconazole | Fluconazole | Antifungal |  | 
15 | 15 |  | fosamprenavir | Fosamprenavir | Pls | 1400mg BID | FPV
16 | 16 | 77995 | indinavir | Indinavir (IDV) | Pls | 800mg TID | IDV
17 | 17 |  | indinavirPlusBostRtv | Indinavir+BostRTV | Pls | 800mg/200mg BID | IDV+BostRTV
18 | 18 | 78280 | isoniazid | Isoniazid (INH) | Anti-TB |  | INH
19 | 19 | 78476 | ketaconazole | Ketaconazole | Antifungal |  | 
20 | 20 | 78643 | lamivudine | Lamivudine (3TC) | NRTIs | 150mg BID | 3TC
21 | 21 | 794 | lopinavirPlusBostRtv | Lopinavir+BostRTV (Kaletra) | Pls | 400mg/100mg BID | Kaletra
22 | 22 |  | nelfinavir | Nelfinavir (NFV) | Pls | 1250mg BID | NFV
23 | 23 | 80586 | nevirapine | Nevirapine (NVP) | NNRTIs | 200mg BID | NVP
24 | 24 | 82900 | pyrazinamide | Pyrazinamide | Anti-TB |  | 
25 | 25 | 767 | rifampicine | Rifampicine | Anti-TB |  | 
26 | 26 | 83412 | ritonavir | Ritonavir (RTV) FULL | Pls | 600mg BID | RTV
27 | 27 | 83690 | saquinavir | Saquinavir (SQV) | Pls | 1200mg BID | SQV
28 | 28 |  | saquinavirPlusBostRtv | Saquinavir+BostRTV (SQV) | Pls | 400mg/400mg BID | SQV
29 | 29 | 84309 | stavudine | Stavudine (d4T) | NRTIs | 40mg BID | d4T
30 | 30 | 84360 | streptomycine | Streptomycine | Anti-TB |  | 
31 | 31 | 84795 | tenofovir | Tenofovir (TNF) | NRTIs | 300mg qd | TNF
32 | 32 |  | tipranavir | Tipranavir (TPV) | Pls | phase III | TPV
33 | 33 | 817 | trizivir | Trizivir (ABC+AZT+3TC) | NRTIs | 300mg/300mg/150mg BID | ABC+AZT+3TC
34 | 34 | 86663 | zidovudine | Zidovudine (AZT) | NRTIs | 300mg BID | AZT
37 | 35 |  | traditional | Traditional | Other Treatments |  | 
39 | 36 | 70116 | acetaminophen | Acetaminophen | Analgesic |  | 
40 | 37 | 71617 | aspirin | Aspirin | Analgesic |  | 
41 | 38 | 77897 | ibuprofen | Ibuprofen | Analgesic |  | 
42 | 39 | 70116 | paracetamol | Paracetamol | Analgesic |  | 
43 | 40 |  | tylenol | Tylenol | Analgesic |  | 
44 | 41 | 70439 | albendazol | Albendazol | Antiparasite |  | 
45 | 42 | 73449 | ciprofloxacin | Ciprofloxacin | Antibiotic |  | 
46 | 43 | 75842 | erythromycin | Erythromycin | Antibiotic |  | 
47 | 44 | 79782 | metromidazole | Metromidazole | Antibiotic |  | 
48 | 45 | 79831 | miconazole | Miconazole | Antifungal |  | 
49 | 46 | 80945 | nystatin | Nystatin | Antifungal |  | 
50 | 47 | 86341 | bcomplex | Bcomplex | Micronutrients |  | 
51 | 48 |  | folicacid | Folicacid | Micronutrients |  | 
52 | 49 |  | iron | Iron | Micronutrients |  | 
53 | 50 | 461 | multivitamin | Multivitamin | Micronutrients |  | 
54 | 51 | 82767 | proteinsupplement | Proteinsupplement | Micronutrients |  | 
55 | 52 | 71589 | vitaminc | Vitaminc | Micronutrients |  | 
56 | 53 | 79037 | loperamide | Loperamide | Other Treatments |  | 
57 | 54 | 82667 | promethazine | Promethazine | Other Treatments |  | 
58 | 55 |  | amoxicilline | Amoxicilline | Antibiotic |  | 
59 | 56 | 73498 | clarithromycin | Clarithromycin | Antibiotic |  | 
60 | 57 | 73546 | clindamycine | Clindamycine | Antibiotic |  | 
61 | 58 | 71184 | amphotericineb | Amphotericine B | Antifungal |  | 
62 | 59 | 78338 | itraconazole | Itraconazole | Antifungal |  | 
63 | 60 | 73300 | chloroquine | Chloroquine | Antiparasite |  | 
64 | 61 |  | pyrimthamine | Pyrimthamine | Antiparasite |  | 
65 | 62 | 83023 | quinine | Quinine | Antiparasite |  | 
66 | 63 | 84459 | sulfadiazine | Sulfadiazine | Antiparasite |  | 
67 | 64 | 78342 | ivermectine | Ivermectine | Antiparasite |  | 
68 | 65 | 82912 | pyridoxine | Pyridoxine | Micronutrients |  | 
69 | 66 |  | azythroProph | Azythromycin for MAC prophylaxis | Antibiotic |  | 
70 | 67 |  | azythroOther | Azythromycin for other indication | Antibiotic |  | 
71 | 68 | 73498 | clarithromycin | Clarithromycin | Antibiotic |  | 
72 | 69 |  | cotrimoxazoleProph | Cotrimoxazole (TMS) for MAC prophylaxis | Antibiotic |  | TMS
73 | 70 |  | cotrimoxazoleOther | Cotrimoxazole (TMS) for other indication | Antibiotic |  | TMS
74 | 71 |  | asa | ASA | Analgesic |  | 
75 | 72 | 74778 | diclofenac | Diclofenac Sodium | Analgesic |  | 
76 | 73 |  | amoxicillineclav | Amoxicillin + clavulanic acid | Antibiotic |  | 
77 | 74 | 71780 | azithromycin | Azithromycin | Antibiotic |  | 
78 | 75 | 79413 | mebendazole | Mebendazol | Antiparasite |  | 
97 | 76 | 72075 | benzyl | Benzoate de benzyl | Other Treatments |  | benzyl
98 | 77 | 72401 | bromhexine | Bromhexine | Other Treatments |  | bromhexine
99 | 78 | 493 | calamine | Calamine | Other Treatments |  | calamine
100 | 79 |  | doxycycline | Doxycycline | Antibiotic |  | doxycycline
101 | 80 | 75633 | enalapril | Enalapril | Other Treatments |  | enalapril
102 | 81 | 77696 | hctz | Hctz | Other Treatments |  | hctz
103 | 82 | 70994 | hydroxalum | Hydroxyde d'aluminium | Other Treatments |  | hydroxalum
104 | 83 |  | mucolitique | Mucolitique | Other Treatments |  | mesna
105 | 84 | 81724 | pnc | Pnc | Antibiotic |  | pnc
106 | 85 | 82521 | primaquine | Primaquine | Antiparasite |  | 
108 | 87 | 154378 | Raltegravir | Raltegravir | II | 400 mg 1Co BID | RAL
109 | 88 | 74258 | Darunavir | Darunavir | Pls | 300mg 2co BID | DRV
110 | 89 | 165085 | dolutegravir | Dolutegravir | II | 50 mg qd | DTG
111 | 90 | 159810 | etravirine | Etravirine | NNRTIs |  | ETV
112 | 91 | 165093 | Elviltegravir | Elviltegravir | II | 150 mg qd | EVG
"""

# Antiretroviral drugs. concept id | name
ARV_DRUGS = """
70056 | Abacavir(ABC)
630 | Combivir(AZT+3TC)
74807 | Didanosine(ddI)
75628 | Emtricitabine(FTC)
78643 | Lamivudine(3TC)
84309 | Stavudine(d4T)
84795 | Tenofovir(TDF)
817 | Trizivir(ABC+AZT+3TC)
86663 | Zidovudine(AZT)
75523 | Efavirenz(EFV)
80586 | Nevirapine(NVP)
71647 | Atazanavir(ATV)
159809 | Atazanavir+BostRTV
77995 | Indinavir(IDV)
794 | Lopinavir + BostRTV(Kaletra)
74258 | Darunavir
154378 | Raltegravir
165085 | Dolutegravir(DTG)
165093 | Elviltegravir(EVG)
80487 | Nelfinavir (NFV)
159810 | Etravirine(ETV)
83690 | Saquinavir (SQV)
"""

# Treatment status labels. id | English | French
STATUSES = """
1 | Death on ART | Décédés sous ARV
2 | Transfert | Transférés sous ARV
3 | Stopped | Arrêtés sous ARV
4 | Died during the transition period | Décédé durant la période de transition
5 | Transferred during the transition period | Transféré durant la période de transition
6 | Regular | Réguliers (actifs sous ARV)
7 | Recent during the transition period | Récent durant la période de transition
8 | Missing appointment | Rendez-vous ratés sous ARV
9 | Lost to follow-up | Perdus de vue sous ARV
10 | Lost of follow up during the transition period | Perdu de vue durant la période de transition
11 | Active during the transition period | Actif durant  la période de transition
12 | Discontinued during the transition period | Arrêtés durant la période de transition
13 | ongoing | En cours
"""

# Alert labels. id | English | French
ALERTS = """
1 | Patients 6 months after ART initiation | Le patient est sous ARV depuis 6 mois sans un résultat de charge virale
2 | Patients 5 months after ART initiation | Le patient sous  ARV depuis 5 mois sans un résultat de charge virale
3 | Pregnant woman 4 months after ART initiation | La patiente est enceinte, sous ARV depuis 4 mois sans un résultat de charge virale
4 | Patient whose last viral load test was performed 12 months prior | La dernière charge virale de ce patient remonte à au moins 12 mois
5 | Patient  whose viral test result was greater than 1000 copies and was performed 3 months ago | La dernière charge virale de ce patient remonte à au moins 3 mois et le résultat était > 1000 copies/ml
6 | Patient with a VL test of >1000 copies | La dernière charge virale du patient est >1000 copies/ml
7 | The patient must replenish his ARVs within the next 30 days | Le patient doit venir renflouer ses ARV dans les 30 prochains jours
8 | Patient no longer has medications available | Le patient n a plus de médicaments disponibles
9 | Patient on ARV and anti-tuberculosis treatment | Patient sous ARV et traitement anti tuberculeux
"""

# Vaccines. id | name | concept uuid
VACCINES = """
1 | Hépatite B | 782AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA
2 | Polio (OPV/IPV) | 783AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA
3 | DiTePer | 781AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA
4 | HIB | 5261AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA
5 | Pentavalent | 1423AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA
6 | Pneumocoque | 82215AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA
7 | Rotavirus | 83531AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA
8 | ROR | 159701AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA
9 | RR | 162586AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA
10 | DT | 17AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA
11 | Varicelle | 73193AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA
12 | Typhimvi | 86208AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA
13 | Meningo AC | 105030AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA
14 | Hépatite A | 77424AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA
15 | Cholera | 73354AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA
16 | BCG | 886AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA
17 | HPV | 159708AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA
18 | Diphtérie/Tétanos | 104528AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA
19 | Oxford AstraZeneca | 166156AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA
20 | Moderna | 166154AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA
21 | Pfizer-BioNTech | 166155AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA
22 | Gamaleya-Sputnick V (Russia) | 166157AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA
23 | Sinovac(China)/Sinopharm(China) | 166249AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA
24 | Johnson and Johnson (Janssen) | 166355AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA
"""

# Surveillance indicators.
# rule | type written | answer concepts, or a concept uuid | certainty (empty = any) | label
INDICATORS = """
1 | 1 | 160146 | suspected | Agression par animal suspecte de rage
2 | 2 | 114190 | suspected | Coqueluche Suspect
3 | 3 | 122604 | suspected | Cholera Suspect
4 | 4 | 134612 |  | Deces Maternel
5 | 5 | 119399 | suspected | Diphterie probable
6 | 6 | 1b4d09df-4f9f-44ff-9e7b-c1eba6514289 |  | Evenement supose etre attribuable a la vaccination et a l’immunisation (esavi)
7 | 7 | 115835 | suspected | Meningite Suspect
8 | 8 | 87275706-5e87-4562-8cdc-b9d1e1649f83 |  | Microcephalie congenitale
9 | 9 | 116128 | confirmed | Paludisme confirme
10 | 10 | 160426 |  | Paralysie flasque aigue(pfa)
11 | 11 | 114120 | suspected | Peste suspecte
12 | 12 | 160146 |  | Rage humaine
13 | 13 | 134561 | suspected | Rougeole/rubeole suspecte
14 | 14 | 139233 |  | Syndrome de guillain barre
15 | 15 | 163392 |  | Syndrome de fievre hemmoragique aigue
16 | 16 | 113205 |  | Syndrome de rubeole congenitale
17 | 17 | 124957 |  | Tetanos neonatal (tnn)
18 | 18 | 50d568a4-2e65-420c-8d9c-8b63f146e2c5 |  | Toxi-infection alimentaire collective (tiac)
19 | 13 | 121555 | suspected | Charbon cutané suspect
20 | 20 | 142592 | suspected | Dengue suspecte
21 | 21 | 142473 142474 |  | Diabète
22 | 22 | 161887 |  | Diarrhée aigue aqueuse
23 | 23 | 138868 |  | Diarrhée aigue sanglante
24 | 24 | 141 | suspected | Fièvre typhoïde suspecte
25 | 25 | 119354 | suspected | Filariose probable
26 | 26 | 154983 |  | Infection respiratoire aigue
27 | 27 | 163402 |  | Syndrome ictérique fébrile
28 | 28 | 124957 |  | Tétanos
29 | 29 | 150452 |  | Accidents (domestiques, voie publique)
30 | 30 | 113753 146221 116023 |  | Cancers (seins, col de l’utérus, prostate, autres)
31 | 31 | 155 |  | Epilepsie
32 | 32 | 117399 |  | Hypertension artérielle (hta)
33 | 33 | 112992 |  | Infection sexuellement transmissible (IST)
34 | 24 | 116344 | suspected | Lèpre suspecte
35 | 35 | 832 126598 134722 134723 |  | Malnutrition
36 | 36 | 143672 |  | Syphilis congénitale
37 | 37 | 158358 |  | Violences (physique, sexuelle)
"""

# Report types. id | French | English
REPORT_TYPES = """
1 | Rapport de surveillance hebdomadaire | Weekly monitoring report
"""
