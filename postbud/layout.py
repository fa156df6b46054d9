"""Fixed values of the delivery: regions, months, output layout, header aliases, overrides.

Everything in this module is a constant that has to be spelled exactly so for the
results to be right. All of it can be replaced through ``DeliveryOptions``.
"""

# The regions that send exports.
REGIONS = ("HSØ", "HV", "HMN")

# Norwegian month abbreviations, January first.
MONTHS = ("jan", "feb", "mar", "apr", "mai", "jun", "jul", "aug", "sep", "okt", "nov", "des")

# The 37 columns of a delivery, in order.
DELIVERY_COLUMNS = (
    "lopenr", "institusjonId", "institusjon", "reshIdFagEnhet", "Fagenhet",
    "KommuneNr", "BydelNr", "FødselsDato", "DødsDato", "pfInstansId",
    "Forløp", "Pakkeforløp", "AntInst", "AntHf", "År",
    "StartDato", "Ainst", "UtrStartDato", "Sinst", "KliniskBeslutn",
    "TypeBeslutn", "Cinst", "StartBeh", "TypeBeh", "Finst",
    "Avslutn", "Xinst", "OF1", "OF1std", "OF2",
    "OF2std", "OF3", "OF3std", "OF4", "OF4std",
    "Overf", "AnsiennDato",
)

# Reduced header text -> column name. Where several headers of one file
# lead to the same column, the entry that stands first here wins.
HEADER_ALIASES = {
    "institusjonid": "institusjonId",
    "institusjon": "institusjon",
    "institusjonnavn": "institusjon",
    "reshidfagenhet": "reshIdFagEnhet",
    "fagenhet": "Fagenhet",
    "enhetnavn": "Fagenhet",
    "nprid": "NPRId",
    "kommunenr": "KommuneNr",
    "kommune": "KommuneNr",
    "bydelnr": "BydelNr",
    "bydel": "BydelNr",
    "fodselsdato": "FødselsDato",
    "dodsdato": "DødsDato",
    "doddato": "DødsDato",
    "pfinstansid": "pfInstansId",
    "forlop": "Forløp",
    "pakkeforlop": "Pakkeforløp",
    "antinst": "AntInst",
    "anthf": "AntHf",
    "ar": "År",
    "startar": "År",
    "startaar": "År",
    "startdato2": "År",
    "startdato": "StartDato",
    "utrstartdato": "UtrStartDato",
    "ainst": "Ainst",
    "sinst": "Sinst",
    "kliniskbeslutn": "KliniskBeslutn",
    "typebeslutn": "TypeBeslutn",
    "cinst": "Cinst",
    "startbeh": "StartBeh",
    "typebeh": "TypeBeh",
    "finst": "Finst",
    "avslutn": "Avslutn",
    "xinst": "Xinst",
    "of1": "OF1",
    "of1std": "OF1std",
    "of2": "OF2",
    "of2std": "OF2std",
    "of3": "OF3",
    "of3std": "OF3std",
    "of4": "OF4",
    "of4std": "OF4std",
    "overf": "Overf",
    "ansienndato": "AnsiennDato",
    "mottaksdato": "MottaksDato",
    "pfforlopsamletid1": "pfInstansId",
    "pakkeforlopkode1": "Forløp",
    "pakkeforlopnavn1": "Pakkeforløp",
    "textbox74": "reshIdFagEnhet",
    "textbox70": "AntInst",
    "textbox72": "AntHf",
    "textbox89": "Ainst",
    "textbox22": "UtrStartDato",
    "textbox44": "Sinst",
    "textbox24": "KliniskBeslutn",
    "textbox26": "TypeBeslutn",
    "textbox106": "Cinst",
    "textbox28": "StartBeh",
    "textbox30": "TypeBeh",
    "textbox114": "Finst",
    "textbox32": "Avslutn",
    "textbox122": "Xinst",
    "textbox54": "Overf",
    "textbox56": "AnsiennDato",
    "textbox58": "MottaksDato",
}

# Person key, year and the municipality that replaces the registered one
# when that year is the latest one known for the person.
LOCATION_OVERRIDES = (
    ("1062924", 2008, "0220"),
    ("2561864", 2008, "0706"),
    ("3200706", 2008, "0906"),
    ("3602577", 2008, "1135"),
)

# File names of the exchange.
EXPORT_NAME = r".*RHF_{region}_{suffix}\.csv"
EXPORT_NAME_WITHOUT_MONTH = r".*RHF_{region}\.csv"
REQUEST_NAME = "NPRId_RHF_Pakkeforløp_{suffix}.csv"
RETURN_NAME = "NPRId_RHF_Pakkeforløp_{suffix}_lnr.csv"
DELIVERY_NAME = "Utlevering_{region}_{suffix}.csv"
UNMAPPED_NAME = "QC_missing_lopenr_NPRId_{suffix}.csv"
MISSING_COLUMNS_NAME = "QC_missing_columns_{region}_{suffix}.csv"
SUMMARY_NAME = "QC_summary_{suffix}.csv"
METRICS_NAME = "Run_metrics_{suffix}.csv"
