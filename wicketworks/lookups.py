"""Fixed lookup values of the match domain."""

from __future__ import annotations

# Team codes used in player labels and the names they stand for.
COUNTRY_CODES = {
    "LES": "Lesotho", "BUL": "Bulgaria", "VAN": "Vanuatu", "ROM": "Romania",
    "Aut": "Austria", "COK": "Cook Islands", "Fran": "France", "SRB": "Serbia",
    "PAK": "Pakistan", "HUN": "Hungary", "CYP": "Cyprus", "Fiji": "Fiji",
    "FIN": "Finland", "EST": "Estonia", "CHN": "China", "GRC": "Greece",
    "CAM": "Cambodia", "GUE": "Guernsey", "SEY": "Seychelles", "JPN": "Japan",
    "TAN": "Tanzania", "JER": "Jersey", "QAT": "Qatar", "ENG": "England",
    "UGA": "Uganda", "BER": "Bermuda", "CZK-R": "Czech Republic", "CAY": "Cayman Islands",
    "IRE": "Ireland", "Mali": "Mali", "BRA": "Brazil", "SUI": "Switzerland",
    "Peru": "Peru", "Mex": "Mexico", "MOZ": "Mozambique", "Samoa": "Samoa",
    "HKG": "Hong Kong", "BAN": "Bangladesh", "SL": "Sri Lanka", "PNG": "Papua New Guinea",
    "ZIM": "Zimbabwe", "GHA": "Ghana", "SWZ": "Eswatini", "MYAN": "Myanmar",
    "IND": "India", "USA": "United States of America", "NEP": "Nepal", "AFG": "Afghanistan",
    "PAN": "Panama", "NGA": "Nigeria", "SLE": "Sierra Leone", "ESP": "Spain",
    "Bhm": "Bahamas", "TKY": "Turkey", "MWI": "Malawi", "WI": "West Indies",
    "IOM": "Isle of Man", "THA": "Thailand", "SWA": "Eswatini", "SKOR": "South Korea",
    "GMB": "Gambia", "ISR": "Israel", "KUW": "Kuwait", "Belg": "Belgium",
    "GER": "Germany", "ITA": "Italy", "CAN": "Canada", "MDV": "Maldives",
    "Blz": "Belize", "DEN": "Denmark", "INA": "Indonesia", "KENYA": "Kenya",
    "LUX": "Luxembourg", "STHEL": "Saint Helena", "BHR": "Bahrain", "KSA": "Saudi Arabia",
    "MLT": "Malta", "Arg": "Argentina", "MNG": "Mongolia", "AUS": "Australia",
    "GIBR": "Gibraltar", "SGP": "Singapore", "Chile": "Chile", "UAE": "United Arab Emirates",
    "NZ": "New Zealand", "SCOT": "Scotland", "BHU": "Bhutan", "MAS": "Malaysia",
    "BOT": "Botswana", "CRC": "Costa Rica", "PHI": "Philippines", "NAM": "Namibia",
    "RWN": "Rwanda", "OMA": "Oman", "NOR": "Norway", "CRT": "Croatia",
    "SWE": "Sweden", "Iran": "Iran", "PORT": "Portugal", "NED": "Netherlands",
    "SA": "South Africa", "SVN": "Slovenia", "BHM": "Bahamas",
}

# Composite codes of mixed teams.
MIXED_TEAM_CODES = {
    "ICC/PAK": "Pakistan", "ICC/SL": "Sri Lanka", "ICC/IND": "India", "ICC/NEP": "Nepal",
    "BAN/ICC": "Bangladesh", "AFG/ICC": "Afghanistan", "SL/World": "Sri Lanka",
    "SA/World": "South Africa", "AUS/World": "Australia", "BAN/World": "Bangladesh",
    "WI/World": "West Indies",
}

# Codes that stand for no country.
OUTLIER_CODES = {
    "1": "Miscellaneous Country 1", "2": "Miscellaneous Country 2",
    "3": "Miscellaneous Country 3", "ICC": "International Cricket Council",
    "World": "World XI",
}

# Short team names of the statistics pages and the full names of the match files.
TEAM_NAMES = {
    "U.S.A.": "United States of America",
    "U.A.E.": "United Arab Emirates",
    "Czech Rep.": "Czech Republic",
    "P.N.G.": "Papua New Guinea",
    "Cayman": "Cayman Islands",
}
