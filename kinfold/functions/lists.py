"""Word lists, abbreviations and rewriting tables that the normalisers of names and places apply, in order."""

from __future__ import annotations

#: Name suffixes.
SUFFIXES = ('jr', 'j.r.', 'jr.', 'junior', 'sr', 's.r.', 'sr.', 'senior', 'iii', 'i.i.i.', 'iii.', 'iv', 'i.v.', 'iv.', 'v', 'v.', 'v.i.', 'v.i.i.', 'v.i.i.i', 'ix', 'i.x.', 'ix.', 'x', 'x.')

#: Abbreviations of organisation names.
ABBREVIATIONS = {
    'corp': 'corporation',
    'ltd': 'limited',
    'co': 'company',
    'pvt': 'private',
    'ag': 'aktiengesellschaft',
    'llc': 'limited liability company',
    'inc': 'incorporated',
    'lab': 'laboratory',
    'mfg': 'manufacturing',
    'lp': 'limited partnership',
    'tech': 'technology',
    'gmbh': 'gesellschaft mit beschrankter haftung',
    'intl': 'international',
    'llp': 'limited liability partnership',
    'nv': 'naamloze venootschap',
    'bv': 'besloten vennootschap',
}

#: Phrases that organisation names lose, in this order.
STOP_PHRASES = (
    'on behalf of',
    'for use and benefit of',
    'fellows and scholars of',
    'her majesty the queen',
    'president and fellows of',
    'a component of',
    'board of regents',
    'regents of the',
    'gesellschaft mit beschrankter haftung',
    'limited liability company',
    'limited liability partnership',
    'limited partnership',
    'office of technology transfer',
    'trading as',
    'trading under',
    'naamloze venootschap',
    'besloten vennootschap',
    'societa a',
    'societa a responsabilita limitata',
    'societa anonima',
    'societa consortile',
    'societa consortile a responsabilita',
    'societa consortile arl',
    'societa consortile per azion',
    'societa consortile per azioni',
    'societa cooperativa',
    'societa cooperativa a',
    'societa in accomandita',
    'societa in accomandita semplice',
    'societa in nome collettivo',
    'societa industria',
    'societa per axioni',
    'societa per azinoi',
    'societa per azinoni',
    'societa per azioni',
    'societa per azioni:',
    'societa per l industria',
    'societa perazioni',
    'technology transfer',
    'the Administrator of',
    'the board of supervisors of',
    'the board of trustees of the',
    'the regents of the',
    'the research foundation of',
    'the secretary of the',
    'the trustees of',
    'the united states of america as represented by the',
    'societe a',
    'societe a responsabilite',
    'societe a responsabilite dite',
    'societe a responsabilitee',
    'societe ananyme',
    'societe annoyme',
    'societe anomyme',
    'societe anomyne',
    'societe anonvme',
    'societe anonym',
    'societe anonyme',
    'societe anoyme',
    'societe chimique',
    'societe civile',
    'societe cooperative',
    'societe d applications generales',
    'societe d applications mecaniques',
    'societe d equipement',
    'societe d etude et de construction',
    'societe d etude et de recherche en ventilation',
    'societe d etudes et',
    'societe d etudes techniques et d entreprises',
    'societe de',
    'societe de conseils de recherches et d applications',
    'societe de constructio',
    'societe de fabricaiton',
    'societe de fabrication',
    'societe de production et de',
    'societe des transports',
    'societe dite',
    'societe dite :',
    'societe dite:',
    'societe en',
    'societe en commandite',
    'societe en commandite enregistree',
    'societe en nom collectif',
    'societe etudes et',
    'societe etudes et developpements',
    'societe generale pour les',
    'societe generale pour les techniques novelles',
    'societe metallurgique',
    'societe nouvelle',
    'societe par actions',
    'societe par actions simplifee',
    'societe par actions simplifiee',
    'societe technique d application et de recherche',
    'societe technique de pulverisation',
    'private limited',
    'patent foundation',
    'sociedad anonima',
    'sociedad anonimya',
    'sociedad industrial',
    'sociedad limitada',
    'sociedade limitada',
    'societ civile',
    'aktiebolag',
    'aktiengesellschaft',
    'aktsionernoe',
    'associate',
    'companies',
    'company',
    'consultant',
    'consulting',
    'cooperative',
    'corporation',
    'firm',
    'foundation',
    'Gesellschaft',
    'group',
    'handelsbolag',
    'holding',
    'holdings',
    'incorporated',
    'kabushiki',
    'kaisha',
    'Kommanditgesellschaft',
    'liability',
    'limited',
    'partners',
    'partnership',
    'private',
    'regent',
    'represented',
    'sociedad',
    'societa',
    'societaperazioni',
    'societe',
    'societeanonyme',
    'societedite',
    'societeindustrielle',
    'trustees',
    'vennootschap',
    'and',
    'of',
    'the',
)

#: What stands for an unknown place.
UNKNOWN_PLACES = ('', 'un', 'unknown', 'null')

#: Ends of city names.
CITY_ENDS = (
    (' twp', 'township'),
    (' twp.', 'township'),
    (' pk', 'park'),
    (' nsw', 'new south wales'),
    (' on', 'ontario'),
    (' hsien', 'county'),
)

#: Beginnings of city names.
CITY_STARTS = (
    ('e ', 'east'),
    ('e. ', 'east'),
    ('n ', 'north'),
    ('n. ', 'north'),
    ('w ', 'west'),
    ('w. ', 'west'),
    ('s ', 'south'),
    ('s. ', 'south'),
    ('ft ', 'fort'),
    ('ft. ', 'fort'),
    ('st. ', 'saint '),
    ('st ', 'saint '),
    ('mt. ', 'mount'),
    ('mt ', 'mount'),
    ('late of', ''),
    ('d-', ''),
    ('l-', ''),
    ('i-', ''),
)

#: Regions inside city names.
REGIONS_IN_CITIES = (
    ' new south wales',
    ' ontario',
)

#: Mistaken country codes.
COUNTRY_FIXES = (
    (' cax', 'ca'),
    (' nlx', 'nl'),
    (' gb2', 'gb'),
    (' atx', 'at'),
    (' ja', 'jp'),
    (' twx', 'tw'),
    (' dt', 'de'),
    (' ja', 'jp'),
    (' dex', 'de'),
    (' frx', 'fr'),
    (' jpx', 'jp'),
    (' dex', 'de'),
    (' ilx', 'il'),
    (' en', 'gb'),
)

#: Whole places, city|region|country.
PLACES = {
    'alexandria||nz': 'alexandra||nz',
    'alexandria||va': 'alexandria|va|us',
    'coplex|oh|us': 'copley|oh|us',
    'daejeon-shi||kr': 'daejeon||kr',
    'daejeon-si||kr': 'daejeon||kr',
    'daejon-si||kr': 'daejeon||kr',
    'daejun-shi||kr': 'daejeon||kr',
    'hong kong||cn': 'hong kong||cn',
    'hong kong||hk': 'hong kong||cn',
    'hong kong hong kong||cn': 'hong kong||cn',
    'lexington massachusetts|ma|us': 'lexington|ma|us',
    'lexington nova scotia||ca': 'lexington|nova scotia|ca',
    'exington park||md': 'lexington park|md|us',
    'los angles|ca|us': 'los angeles|ca|us',
    'lexington||ky': 'lexington|ky|us',
    'los alto hills|ca|us': 'los altos hills|ca|us',
    '|maharashtra|in': '|maharashtra|in',
    'maharastra||in': '|maharashtra|in',
    'menlo|ca|us': 'menlo park|ca|us',
    'motte servolex frx||la': 'motte servolex|la|fr',
    'moutainview|ca|us': 'moutain view|ca|us',
    'westchester|oh|us': 'west chester|oh|us',
    'wheatridge|co|us': 'wheat ridge|co|us',
    'toronto||ca': 'toronto|ontario|ca',
    'toyota||jp': 'toyota||jp',
    'toyota-shi|aichi|jp': 'toyota||jp',
    'toyota-shi aichi-ken||jp': 'toyota||jp',
    'tao yuan||tw': 'taoyuan||tw',
    'taipei hsien||tw': 'taipei county||tw',
    'taipei city||tw': 'taipei||tw',
    'rosh ha&#8242;ayin||il': 'rosh haayin||il',
    'petach tikva||il': 'petah tikva||il',
    'petach tikve||il': 'petah tikva||il',
    'oakbrook|il|us': 'oak brook|il|us',
    "notre dame i'{circumflex over (l)}le perrot|de|ca": "notre dame de l'{circumflex over (l)}le perrot||ca",
    'north|bay|ca': 'north bay|ontario|ca',
    'north vancouver british columbia||ca': 'north vancouver|british columbia|ca',
    'north vancouver||ca': 'north vancouver|british columbia|ca',
    'neihu dist. taipei||tw': 'neihu locality taipei||tw',
    'saint gilles lex bruxelles||us': 'saint gilles lex brussels||be',
    'saint paul varces|de|fr': 'saint paul de varces||fr',
    'roundrock|tx|us': 'round rock|tx|us',
    'on|bolton|ca': 'bolton|ontario|ca',
    'offenbach||de': 'offenbach am main||de',
    'minneapolis|mi|us': 'minneapolis|mn|us',
}

#: Misspelt cities.
CITIES = {
    'lexignton': 'lexington',
    'lexiington': 'lexington',
    'lexingotn': 'lexington',
    'lexingron': 'lexington',
    'lexingtion': 'lexington',
    'lexingtong': 'lexington',
    'lexingtown': 'lexington',
    'lexintgon': 'lexington',
    'lexinggton': 'lexington',
    'lexinton': 'lexington',
    'lexngton': 'lexington',
    'lextington': 'lexington',
    'lexnigton': 'lexington',
    'lexongton': 'lexongton',
    'los angelex': 'los angeles',
    'middlexex': 'middlesex',
    'middlexsex': 'middlesex',
    'munchen': 'munich',
    'schwabisch gmund': 'schwaebisch gmuend',
    'taoyuan': 'tao yuan',
    'vaerlose': 'vaerloese',
    'wheatridge': 'wheat ridge',
}
