"""Fixed values that results depend on.

Every table here is data, not logic: word lists, lookup tables and thresholds whose exact
content decides a result, each complete. The ISO country list comes from the JVM.
"""

from __future__ import annotations

# ---- fixed values: event types -------------------------------------------------------------
EVENT_TYPES = [
    "PushEvent",
    "PullRequestEvent",
    "IssuesEvent",
    "ForkEvent",
    "WatchEvent",
    "CreateEvent",
    "DeleteEvent",
    "GollumEvent",
    "MemberEvent",
    "PublicEvent",
    "OrganizationEvent",
]

# ---- fixed values: texts in a location field that name no place -----------------------------
NON_LOCATIONS = [
    "remote", "worldwide", "global", "earth", "moon", "mars", "internet", "web", "online",
    "virtual", "home", "everywhere", "anywhere", "nowhere", "n/a", "not specified",
    "not applicable", "unknown", "undisclosed",
]

# Texts that mean "no value" once special characters are gone.
NULL_WORDS = ["na", "n/a", "null", "none", "nil", "undefined", "-"]

# Words that mark a person as not tied to a place.
REMOTE_WORDS = ["remote", "anywhere", "everywhere"]

# ---- fixed values: substring rules, first hit wins -------------------------------------------
SUBSTRING_CITIES = """
san francisco=US, new york=US, seattle=US, london=GB, berlin=DE, paris=FR, tokyo=JP, sydney=AU,
toronto=CA, bangalore=IN, beijing=CN, mumbai=IN, sao paulo=BR
"""
SUBSTRING_COUNTRIES = """
usa=US, united states=US, uk=GB, united kingdom=GB, germany=DE, deutschland=DE, france=FR,
japan=JP, australia=AU, canada=CA, india=IN, china=CN, brazil=BR, brasil=BR
"""

# country code, region, terms of the quick heuristic; first group with a hit wins.
HEURISTIC_GROUPS = """
US | North America | usa, united states, u.s., u.s.a., america
GB | Europe | uk, united kingdom, england, britain, scotland, wales
CA | North America | canada
DE | Europe | germany, deutschland, berlin, munich, frankfurt
IN | Asia | india, bangalore, mumbai, delhi, hyderabad
CN | Asia | china, beijing, shanghai, shenzhen, guangzhou
JP | Asia | japan, tokyo, osaka, kyoto
BR | South America | brazil, brasil, sao paulo, rio
AU | Oceania | australia, sydney, melbourne, brisbane
FR | Europe | france, paris, lyon, marseille
"""

# ---- fixed values: country names in order of precedence --------------------------------------
COUNTRY_NAMES = """
united states=US, usa=US, u.s.a=US, u.s.=US, america=US, united states of america=US,
the united states=US, the us=US, canada=CA, mexico=MX,
united kingdom=GB, uk=GB, britain=GB, great britain=GB, england=GB, scotland=GB, wales=GB,
northern ireland=GB, germany=DE, deutschland=DE, france=FR, italy=IT, italia=IT, spain=ES,
españa=ES, netherlands=NL, holland=NL, sweden=SE, switzerland=CH, norway=NO, denmark=DK,
finland=FI, poland=PL, austria=AT, belgium=BE, ireland=IE, portugal=PT, greece=GR,
czech republic=CZ, czechia=CZ, the czech republic=CZ, hungary=HU, romania=RO, bulgaria=BG,
croatia=HR, serbia=RS, ukraine=UA, belarus=BY, slovakia=SK, slovenia=SI, estonia=EE, latvia=LV,
lithuania=LT, luxembourg=LU, malta=MT, cyprus=CY, iceland=IS,
india=IN, china=CN, japan=JP, south korea=KR, korea=KR, taiwan=TW, hong kong=HK, singapore=SG,
malaysia=MY, indonesia=ID, thailand=TH, vietnam=VN, philippines=PH, pakistan=PK, bangladesh=BD,
sri lanka=LK, nepal=NP, israel=IL, turkey=TR, saudi arabia=SA, uae=AE, united arab emirates=AE,
iran=IR, iraq=IQ, qatar=QA, kuwait=KW, oman=OM, jordan=JO, lebanon=LB,
australia=AU, new zealand=NZ, fiji=FJ, papua new guinea=PG,
south africa=ZA, egypt=EG, morocco=MA, nigeria=NG, kenya=KE, ghana=GH, ethiopia=ET, tanzania=TZ,
algeria=DZ, tunisia=TN,
brazil=BR, brasil=BR, argentina=AR, chile=CL, colombia=CO, peru=PE, venezuela=VE, ecuador=EC,
bolivia=BO, paraguay=PY, uruguay=UY,
russia=RU, russian federation=RU, kazakhstan=KZ, uzbekistan=UZ, turkmenistan=TM, kyrgyzstan=KG,
tajikistan=TJ, azerbaijan=AZ, armenia=AM, georgia=GE, moldova=MD
"""

# ---- fixed values: US states and territories --------------------------------------------------
US_STATES = """
alabama, alaska, arizona, arkansas, california, colorado, connecticut, delaware, florida, georgia,
hawaii, idaho, illinois, indiana, iowa, kansas, kentucky, louisiana, maine, maryland,
massachusetts, michigan, minnesota, mississippi, missouri, montana, nebraska, nevada,
new hampshire, new jersey, new mexico, new york, north carolina, north dakota, ohio, oklahoma,
oregon, pennsylvania, rhode island, south carolina, south dakota, tennessee, texas, utah, vermont,
virginia, washington, west virginia, wisconsin, wyoming, district of columbia, washington dc,
washington d.c., dc, d.c., puerto rico, guam, american samoa, virgin islands,
northern mariana islands
"""
US_STATE_CODES = """
al ak az ar ca co ct de fl ga hi id il in ia ks ky la me md ma mi mn ms mo mt ne nv nh nj nm ny nc
nd oh ok or pa ri sc sd tn tx ut vt va wa wv wi wy pr gu as vi mp
"""

# ---- fixed values: cities, by precedence --------------------------------------------------------
# Complete: 425 entries, 422 cities. A caller's own gazetteer is a parameter (`cities=`) of the
# resolvers. A city that occurs twice keeps its first place in the order and its last country.
CITIES = """
US: new york city, nyc, los angeles, chicago, houston, phoenix, philadelphia, san antonio
US: san diego, dallas, san jose, austin, jacksonville, fort worth, columbus, san francisco
US: charlotte, indianapolis, seattle, denver, boston, portland, las vegas, detroit, atlanta, miami
US: minneapolis, pittsburgh, cincinnati, cleveland, nashville, salt lake city, baltimore, brooklyn
US: manhattan, queens, bronx, staten island, silicon valley, bay area
CA: toronto, montreal, vancouver, ottawa, calgary, edmonton, quebec city, winnipeg, hamilton
MX: mexico city, guadalajara, monterrey, puebla
GB: london, manchester, birmingham, glasgow, liverpool, edinburgh, bristol, cardiff, belfast
GB: cambridge, oxford, leeds, newcastle, sheffield
DE: berlin, munich, hamburg, cologne, frankfurt, stuttgart, düsseldorf, dusseldorf, dortmund, essen
DE: leipzig, bremen, dresden, hannover, nuremberg, duisburg, bochum, wuppertal, bielefeld, bonn
DE: münster, munster, karlsruhe, mannheim, augsburg, wiesbaden, gelsenkirchen, mönchengladbach
DE: braunschweig, kiel, chemnitz, aachen, halle, magdeburg, freiburg, krefeld, lübeck, oberhausen
DE: erfurt, mainz, rostock, kassel, hagen, hamm, saarbrücken, mülheim, potsdam, ludwigshafen
DE: oldenburg, leverkusen, osnabrück, solingen
FR: paris, marseille, lyon, toulouse, nice, nantes, strasbourg, montpellier, bordeaux, lille
FR: rennes, reims, le havre, saint-étienne, toulon, grenoble, dijon, angers, nîmes, villeurbanne
IT: rome, roma, milan, milano, naples, napoli, turin, torino, palermo, genoa, genova, bologna
IT: florence, firenze, bari, catania, venice, venezia, verona, messina, padua, padova, trieste
IT: brescia, prato, taranto
ES: madrid, barcelona, valencia, seville, sevilla, zaragoza, málaga, malaga, murcia, palma
ES: las palmas, bilbao, alicante, córdoba, cordoba, valladolid, vigo, gijón, gijon, eixample
NL: amsterdam, rotterdam, the hague, utrecht, eindhoven, tilburg, groningen, almere, breda
NL: nijmegen
CZ: prague, praha
PL: warsaw, warszawa
HU: budapest
AT: vienna, wien
BE: brussels, bruxelles
DK: copenhagen, københavn
SE: stockholm
FI: helsinki
NO: oslo
GR: athens
PT: lisbon, lisboa
IE: dublin
CH: zurich, zürich, geneva, basel, bern
SK: bratislava
SI: ljubljana
HR: zagreb
LV: riga
EE: tallinn
LT: vilnius
RO: bucharest
BG: sofia
RS: belgrade
BY: minsk
UA: kyiv, kiev
CN: beijing, shanghai, guangzhou, shenzhen, tianjin, wuhan, chengdu, chongqing, nanjing, xian
CN: hangzhou, shenyang, qingdao, jinan, dalian, zhengzhou, changsha, fuzhou, harbin, suzhou
JP: tokyo, osaka, yokohama, nagoya, sapporo, kobe, kyoto, fukuoka, kawasaki, saitama, hiroshima
JP: sendai, kitakyushu, chiba, sakai
KR: seoul, busan, incheon, daegu, daejeon, gwangju, suwon, ulsan, changwon, goyang
IN: mumbai, delhi, bangalore, bengaluru, hyderabad, ahmedabad, chennai, kolkata, surat, pune
IN: jaipur, lucknow, kanpur, nagpur, indore, thane, bhopal, visakhapatnam, pimpri-chinchwad, patna
IN: vadodara, ghaziabad, ludhiana, agra
SG: singapore
TW: taipei
HK: hong kong
TH: bangkok
MY: kuala lumpur
ID: jakarta
PH: manila
VN: ho chi minh city, hanoi
MM: yangon
PK: karachi, lahore
BD: dhaka
LK: colombo
NP: kathmandu
IL: tel aviv, jerusalem
TR: istanbul, ankara, izmir
AE: dubai, abu dhabi
SA: riyadh, jeddah
QA: doha
KW: kuwait city
OM: muscat
JO: amman
LB: beirut
IR: tehran
IQ: baghdad
AU: sydney, melbourne, brisbane, perth, adelaide, gold coast, canberra, newcastle, wollongong
NZ: auckland, wellington, christchurch, hamilton
EG: cairo, alexandria
MA: casablanca, rabat
TN: tunis
DZ: algiers
NG: lagos, kano, ibadan, abuja
KE: nairobi
GH: accra
ET: addis ababa
TZ: dar es salaam
ZA: johannesburg, cape town, durban, pretoria, port elizabeth
BR: são paulo, sao paulo, rio de janeiro, brasília, brasilia, salvador, fortaleza, belo horizonte
BR: manaus, curitiba, recife, porto alegre
AR: buenos aires, córdoba, rosario, mendoza
CL: santiago, valparaíso, concepción
PE: lima
CO: bogotá, bogota, medellín, medellin, cali
VE: caracas, maracaibo
EC: quito, guayaquil
BO: la paz, santa cruz
PY: asunción, asuncion
UY: montevideo
RU: moscow, saint petersburg, st. petersburg, novosibirsk, yekaterinburg, nizhny novgorod, kazan
RU: chelyabinsk, omsk, samara, rostov-on-don, ufa, krasnoyarsk, voronezh, perm, volgograd
RU: krasnodar, saratov
KZ: almaty, nur-sultan, astana
UZ: tashkent
TM: ashgabat
KG: bishkek
TJ: dushanbe
AZ: baku
AM: yerevan
GE: tbilisi
MD: chisinau
"""

# ---- fixed values: country to region, world-regions view --------------------------------------
WORLD_REGIONS = """
North America: US CA MX
Europe: GB DE FR IT ES NL BE CH AT SE NO DK FI PT IE PL CZ HU RO BG GR HR RS SK SI EE LV LT LU MT
Europe: CY IS AL BA ME MK MD UA BY RU
Asia: CN JP KR IN SG ID MY TH VN PH PK BD LK NP MM KH LA BN MN BT MV TL TW HK
Middle East: IL TR SA AE QA BH KW OM JO LB IQ IR SY PS YE
Oceania: AU NZ FJ PG SB VU WS TO KI MH FM PW NR TV
Africa: ZA NG EG MA KE GH TZ DZ TN ET UG SN CM CI ZM MZ AO ZW NA BW RW MU BJ GA SL
South America: BR AR CO CL PE VE EC BO PY UY GY SR GF
Central America: PA CR NI HN SV GT BZ DO CU JM HT BS BB TT
"""

# ---- fixed values: country to region, continents view -----------------------------------------
CONTINENTS = """
Europe: AL AD AT BE BA BG HR CY CZ DK EE FI FR DE GR HU IS IE IT LV LI LT LU MT MC ME NL MK NO PL
Europe: PT RO RS SK SI ES SE CH GB VA
Asia: AF AM AZ BH BD BT BN KH CN GE IN ID IR IQ IL JP JO KZ KW KG LA LB MY MV MN MM NP KP OM PK PS
Asia: PH QA SA SG KR LK SY TW TJ TH TR TM AE UZ VN YE
Africa: DZ AO BJ BW BF BI CM CV CF TD KM CD DJ EG GQ ER SZ ET GA GM GH GN GW CI KE LS LR LY MG MW
Africa: ML MR MU MA MZ NA NE NG CG RW ST SN SC SL SO ZA SS SD TZ TG TN UG ZM ZW
North America: AG BS BB BZ CA CR CU DM DO SV GD GT HT HN JM MX NI PA KN LC VC TT US
South America: AR BO BR CL CO EC GY PY PE SR UY VE
Oceania: AU FJ KI MH FM NR NZ PW PG WS SB TO TV VU
"""

# ---- fixed values: names of continents and of cities with coordinates -------------------------
CONTINENT_NAMES = {
    "europe": "Europe",
    "asia": "Asia",
    "africa": "Africa",
    "north america": "North America",
    "south america": "South America",
    "australia": "Oceania",
    "oceania": "Oceania",
    "antarctica": "Antarctica",
}
# city, country, region, latitude, longitude
PLACED_CITIES = [
    ("san francisco", "US", "North America", 37.7749, -122.4194),
    ("new york", "US", "North America", 40.7128, -74.0060),
    ("london", "GB", "Europe", 51.5074, -0.1278),
    ("berlin", "DE", "Europe", 52.5200, 13.4050),
    ("paris", "FR", "Europe", 48.8566, 2.3522),
    ("tokyo", "JP", "Asia", 35.6762, 139.6503),
    ("beijing", "CN", "Asia", 39.9042, 116.4074),
    ("sydney", "AU", "Oceania", -33.8688, 151.2093),
    ("mumbai", "IN", "Asia", 19.0760, 72.8777),
]

# ---- fixed values: ISO 3166 names that differ from the JVM's English display names -------------
ISO_NAMES = {
    "AG": "Antigua and Barbuda",
    "BA": "Bosnia and Herzegovina",
    "BL": "Saint Barthélemy",
    "BN": "Brunei Darussalam",
    "BO": "Bolivia, Plurinational State of",
    "BQ": "Bonaire, Sint Eustatius and Saba",
    "CD": "Congo, The Democratic Republic of the",
    "CG": "Congo",
    "CI": "Côte d'Ivoire",
    "CV": "Cabo Verde",
    "FK": "Falkland Islands (Malvinas)",
    "FM": "Micronesia, Federated States of",
    "GS": "South Georgia and the South Sandwich Islands",
    "HK": "Hong Kong",
    "HM": "Heard Island and McDonald Islands",
    "IR": "Iran, Islamic Republic of",
    "KN": "Saint Kitts and Nevis",
    "KP": "Korea, Democratic People's Republic of",
    "KR": "Korea, Republic of",
    "LA": "Lao People's Democratic Republic",
    "LC": "Saint Lucia",
    "MD": "Moldova, Republic of",
    "MF": "Saint Martin (French part)",
    "MM": "Myanmar",
    "MO": "Macao",
    "PM": "Saint Pierre and Miquelon",
    "PN": "Pitcairn",
    "PS": "Palestine, State of",
    "RU": "Russian Federation",
    "SH": "Saint Helena, Ascension and Tristan da Cunha",
    "SJ": "Svalbard and Jan Mayen",
    "ST": "Sao Tome and Principe",
    "SX": "Sint Maarten (Dutch part)",
    "SY": "Syrian Arab Republic",
    "TC": "Turks and Caicos Islands",
    "TR": "Türkiye",
    "TT": "Trinidad and Tobago",
    "TW": "Taiwan, Province of China",
    "TZ": "Tanzania, United Republic of",
    "UM": "United States Minor Outlying Islands",
    "VA": "Holy See (Vatican City State)",
    "VC": "Saint Vincent and the Grenadines",
    "VE": "Venezuela, Bolivarian Republic of",
    "VG": "Virgin Islands, British",
    "VI": "Virgin Islands, U.S.",
    "VN": "Viet Nam",
    "WF": "Wallis and Futuna",
}

# ---- fixed values: sampling strata --------------------------------------------------------------
# (fewest stars, most stars), both ends inclusive; None = open.
STAR_RANGES = [
    (10, 50), (50, 100), (100, 500), (500, 1000), (1000, 5000), (5000, 10000), (10000, 50000),
    (50000, None),
]
SAMPLE_LANGUAGES = [
    "python", "javascript", "java", "go", "rust", "typescript", "c++", "c#", "php", "ruby",
]
# Age in days: (oldest, youngest); None = up to today.
AGE_PERIODS = [(180, None), (365, 180), (730, 365), (1825, 730)]

# Longest description kept, in UTF-8 bytes.
MAX_DESCRIPTION_BYTES = 16 * 1024 * 1024

# Estimated bytes per value of a column, by kind; any other kind counts 0.
COLUMN_WIDTHS = {"int": 4, "boolean": 4, "timestamp": 8, "string": 100}


def pairs(text: str) -> list[tuple[str, str]]:
    """``a=X, b=Y`` -> [(a, X), (b, Y)] in order."""
    items = (item.strip() for item in text.replace("\n", " ").split(","))
    return [tuple(item.split("=")) for item in items if item]


def by_group(text: str, separator: str | None = None) -> list[tuple[str, str]]:
    """``G: a b`` lines -> [(a, G), (b, G)] in order."""
    rows = []
    for line in filter(None, text.strip().splitlines()):
        group, members = line.split(":")
        rows += [(member.strip(), group) for member in members.split(separator)]
    return rows


def words(text: str, separator: str | None = None) -> list[str]:
    return [word.strip() for word in text.replace("\n", " ").split(separator) if word.strip()]
