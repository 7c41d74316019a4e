"""Countries by name, and the regions they belong to."""

from __future__ import annotations

#: Each country and all words for it.
COUNTRIES = {
    "slovensko": ["slovensko", "slovenská republika", "sr", "slovakia"],
    "česko": ["česko", "česká republika", "čr", "czech republic"],
    "poľsko": ["poľsko", "poland", "poľská republika"],
    "maďarsko": ["maďarsko", "hungary", "maďarská republika"],
    "rakúsko": ["rakúsko", "austria", "rakúska republika"],
    "nemecko": ["nemecko", "germany", "nemecká spolková republika", "deutschland"],
    "francúzsko": ["francúzsko", "france", "francúzska republika"],
    "taliansko": ["taliansko", "italy", "talianska republika", "italia"],
    "španielsko": ["španielsko", "spain", "španielske kráľovstvo"],
    "portugalsko": ["portugalsko", "portugal", "portugalská republika"],
    "holandsko": ["holandsko", "netherlands", "holandské kráľovstvo", "nizozemsko"],
    "belgicko": ["belgicko", "belgium", "belgické kráľovstvo"],
    "luxembursko": ["luxembursko", "luxembourg", "luxemburské veľkovojvodstvo"],
    "dánsko": ["dánsko", "denmark", "dánske kráľovstvo"],
    "švédsko": ["švédsko", "sweden", "švédske kráľovstvo"],
    "fínsko": ["fínsko", "finland", "fínska republika"],
    "írsko": ["írsko", "ireland", "írska republika"],
    "grécko": ["grécko", "greece", "grécka republika"],
    "chorvátsko": ["chorvátsko", "croatia", "chorvátska republika"],
    "slovinsko": ["slovinsko", "slovenia", "slovinská republika"],
    "estónsko": ["estónsko", "estonia", "estónska republika"],
    "lotyšsko": ["lotyšsko", "latvia", "lotyšská republika"],
    "litva": ["litva", "lithuania", "litovská republika"],
    "malta": ["malta", "maltská republika"],
    "cyprus": ["cyprus", "cyperská republika"],
    "bulharsko": ["bulharsko", "bulgaria", "bulharská republika"],
    "rumunsko": ["rumunsko", "romania", "rumunská republika"],
    "švajčiarsko": ["švajčiarsko", "switzerland", "švajčiarska konfederácia"],
    "nórsko": ["nórsko", "norway", "nórske kráľovstvo"],
    "island": ["island", "iceland", "islandská republika"],
    "spojené kráľovstvo": ["spojené kráľovstvo", "uk", "united kingdom", "veľká británia", "anglicko"],
    "srbsko": ["srbsko", "serbia", "srbská republika"],
    "čierna hora": ["čierna hora", "montenegro"],
    "bosna a hercegovina": ["bosna a hercegovina", "bosnia and herzegovina"],
    "macedónsko": ["macedónsko", "north macedonia", "severné macedónsko"],
    "albánsko": ["albánsko", "albania", "albánska republika"],
    "kosovo": ["kosovo", "kosovská republika"],
    "moldavsko": ["moldavsko", "moldova", "moldavská republika"],
    "ukrajina": ["ukrajina", "ukraine"],
    "bielorusko": ["bielorusko", "belarus", "bieloruská republika"],
    "rusko": ["rusko", "russia", "ruská federácia"],
    "turecko": ["turecko", "turkey", "turecká republika"],
    "usa": ["usa", "united states", "spojené štáty", "americká"],
    "kanada": ["kanada", "canada"],
    "čína": ["čína", "china", "čínska ľudová republika"],
    "japonsko": ["japonsko", "japan"],
    "južná kórea": ["južná kórea", "south korea", "kórejská republika"],
    "india": ["india", "indická republika"],
    "austrália": ["austrália", "australia", "austrálsky zväz"],
    "brazília": ["brazília", "brazil", "brazílska federatívna republika"],
    "mexiko": ["mexiko", "mexico", "mexické spojené štáty"],
    "argentína": ["argentína", "argentina", "argentínska republika"],
    "južná afrika": ["južná afrika", "south africa", "juhoafrická republika"],
    "egypt": ["egypt", "egyptská arabská republika"],
    "maroko": ["maroko", "morocco", "marocké kráľovstvo"],
    "izrael": ["izrael", "israel", "štát izrael"],
    "saudská arábia": ["saudská arábia", "saudi arabia", "saudské kráľovstvo"],
    "emiráty": ["emiráty", "uae", "spojené arabské emiráty"],
}

#: Regions and their countries; all others are "ostatné".
REGIONS = {
    "európska_únia": [
        "slovensko", "česko", "poľsko", "maďarsko", "rakúsko", "nemecko", "francúzsko", "taliansko",
        "španielsko", "portugalsko", "holandsko", "belgicko", "luxembursko", "dánsko", "švédsko", "fínsko",
        "írsko", "grécko", "chorvátsko", "slovinsko", "estónsko", "lotyšsko", "litva", "malta", "cyprus",
        "bulharsko", "rumunsko",
    ],
    "európa_mimo_eú": [
        "švajčiarsko", "nórsko", "island", "spojené kráľovstvo", "srbsko", "čierna hora",
        "bosna a hercegovina", "macedónsko", "albánsko", "kosovo", "moldavsko", "ukrajina", "bielorusko",
        "rusko", "turecko",
    ],
    "severná_amerika": ["usa", "kanada", "mexiko"],
    "ázia": ["čína", "japonsko", "južná kórea", "india"],
    "ostatné": [],
}
OTHER = "ostatné"


def gazetteer() -> list[tuple[str, list[str]]]:
    """(name, all words for it) of each country."""
    return list(COUNTRIES.items())


def region_of(name: str) -> str:
    return next((region for region, names in REGIONS.items() if name in names), OTHER)
