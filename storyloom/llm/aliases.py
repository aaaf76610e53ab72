"""Labelled spellings of the taxonomy entries: trades, places and parts of a system with the entry that covers them (fixed values).

They extend the reference list of each field; the entries themselves come from the taxonomy table. An entry missing there
brings no alias in. Under (none) stand values known to mean nothing on the list.
"""

NONE = "(none)"

INDUSTRY = {
    "Banking and Insurance": "bank; banks; banking; insurance; insurer; insurers; reinsurance; finance; financial services; finserv; fintech; bfsi; fsi; capital markets; wealth management; asset management; investment; payments; credit union; lending; insurtech; banken; versicherung; versicherungen; finanzdienstleistungen; finanzwesen; finanzbranche; banque; assurance; banque et assurance; services financiers; banca; seguros; bank & ins.",
    "Retail and Grocery": "retail; retailer; retailers; grocery; groceries; supermarket; supermarkets; department store; department stores; e-commerce; ecommerce; online shop; online retail; online store; fashion retail; shop chain; convenience stores; wholesale; handel; einzelhandel; lebensmittelhandel; commerce de détail; grande distribution; distribution retail; épicerie; comercio minorista",
    "Industrial Manufacturing": "manufacturing; manufacturer; mfg; industrial mfg; industrial; factory; factories; machine building; machinery; heavy industry; plant engineering; industrial equipment; electronics manufacturing; maschinenbau; fertigung; industrie; produktion; anlagenbau; industrie manufacturière; fabrication; fabricación",
    "Hospitals and Life Sciences": "hospital; hospitals; life sciences; life sci.; healthcare; health care; health; pharma; pharmaceutical; pharmaceuticals; medtech; biotech; medical; medicine; clinic; clinics; medical devices; hcls; gesundheitswesen; gesundheit; krankenhaus; krankenhäuser; kliniken; santé; hôpitaux; hôpital; salud; sanidad",
    "Schools and Universities": "school; schools; university; universities; education; edu; edtech; higher ed; higher education; academia; academic; college; colleges; k-12; k12; univ. & schools; training; bildung; bildungswesen; schulen; hochschulen; hochschule; universität; enseignement; enseignement supérieur; éducation; formation; educación",
    "Film, Music and Publishing": "film; music; publishing; publisher; publishers; news publisher; newspaper; media; media and entertainment; m&e; entertainment; broadcasting; broadcaster; broadcast; streaming video; streaming; video streaming; television; tv; gaming; games; press; verlage; verlag; medien; verlage & medien; rundfunk; médias; édition; presse; medios",
    "Power and Utilities": "power; utilities; utility; utility company; energy; electricity; electricity grid; grid operator; renewables; renewable energy; solar; wind power; oil & gas; oil and gas; oil; gas; water utility; water; nuclear; energie; energieversorger; energieversorgung; stromversorger; stadtwerke; énergie; électricité; services publics énergie; energía",
    "Vehicles and Mobility": "vehicles; mobility; automotive; auto; auto oem; oem automotive; car maker; carmaker; cars; car manufacturer; ev charging; electric vehicles; ride sharing; ride hailing; car sharing; fleet; automobilindustrie; automobil; fahrzeugbau; mobilität; automobile; industrie automobile; mobilité; automoción",
    "Government and Civic Services": "government; gov; govt.; govt; civic services; public sector; public services; public administration; federal agency; agency; federal; municipality; city council; city; municipal; state agency; ministry; defense; defence; behörden; behörde; öffentlicher dienst; öffentliche verwaltung; verwaltung; secteur public; administration publique; collectivités; sector público",
    "Telecom and Networks": "telecom; telecoms; telco; telecommunications; networks; networking; mobile operator; mobile network operator; carrier; csp; communications service provider; isp; internet provider; internet service provider; broadband provider; broadband; cable operator; telekommunikation; telekom; netzbetreiber; mobilfunk; télécommunications; télécoms; opérateur télécom; telecomunicaciones",
    "Freight and Warehousing": "freight; warehousing; warehouse; logistics; supply chain; supply chain & transport; transport; transportation; shipping; shipping line; parcel delivery; parcels; courier; 3pl; third-party logistics; trucking; haulage; forwarding; rail freight; ports; spedition; logistik; lagerhaltung; transport de marchandises; logistique; fret; logística",
    "Business Software": "software; saas; isv; b2b software; b2b saas; software vendor; software company; enterprise apps; enterprise software; enterprise applications; cloud software; it services; softwarehersteller; softwareanbieter; unternehmenssoftware; éditeur de logiciels; logiciels; logiciel d'entreprise; software empresarial",
    "Household Goods": "household goods; household; household products; consumer products; consumer goods; consumer packaged goods; cpg; fmcg; fast moving consumer goods; packaged goods; home care brands; home care; personal care; cosmetics; appliances; home appliances; konsumgüter; haushaltswaren; gebrauchsgüter; biens de consommation; biens de grande consommation; produits ménagers; bienes de consumo",
    "Travel and Hospitality": "travel; hospitality; t&h; hotels; hotel; airline; airlines; airline & hotel; aviation; tourism; leisure travel; leisure; travel agency; restaurants; cruise; cruises; tourismus; reise; reisen; gastgewerbe; hotellerie; tourisme; voyage; hôtellerie; turismo; viajes",
    "Farming and Food Processing": "farming; farm; farms; food processing; food; food and beverage; food & beverage; beverages; agriculture; agri-food; agrifood; agtech; agritech; agribusiness; dairy; meat processing; fisheries; landwirtschaft; agrar; lebensmittelverarbeitung; lebensmittelindustrie; ernährung; agriculture et alimentation; agroalimentaire; alimentation; agricultura",
    "Construction and Real Estate": "construction; real estate; realty; proptech; property; property developer; property management; building contractor; building; contractor; architecture; aec; engineering and construction; bau; bau & immobilien; immobilien; bauwesen; baugewerbe; construction et immobilier; immobilier; btp; bâtiment; construcción; inmobiliario",
    NONE: "other; others; n/a; na; none; unknown; various; misc; miscellaneous; confidential; tbc; tbd; do not use; see notes; test; sector 7; ghost hunting; dowsing; astrology; tea leaf reading; fortune telling; palm reading; alchemy; unclassified; diverse; sonstiges; autre; divers",
}

REGION = {
    "Northern America": "north america; n. america; na (us/can); us; u.s.; usa; u.s.a.; united states; united states of america; america; us/canada; canada; ca; nordamerika; vereinigte staaten; kanada; amérique du nord; états-unis; norteamérica; estados unidos; toronto; chicago; new york; boston; seattle; california; texas; vancouver; montreal; san francisco; los angeles; denver; dallas; houston; washington",
    "Central and South America": "central america; south america; latin america; latam; c. & s. america; mexico & latam; mexico; méxico; brazil; brasil; argentina; chile; colombia; peru; ecuador; uruguay; bolivia; venezuela; costa rica; panama; guatemala; caribbean; lateinamerika; südamerika; mittelamerika; brasilien; mexiko; kolumbien; amérique latine; amérique du sud; américa latina; bogotá; são paulo; lima; santiago; buenos aires; mexico city; rio de janeiro; medellín",
    "British Isles": "uk; u.k.; united kingdom; great britain; britain; england; scotland; wales; northern ireland; ireland; uk&i; uk & ireland; uki; gb; grossbritannien; vereinigtes königreich; irland; royaume-uni; angleterre; irlande; reino unido; london; manchester; edinburgh; glasgow; dublin; birmingham; cardiff; belfast; leeds",
    "Nordics": "nordic; nordic countries; scandinavia; skandinavien; scandinavie; nordeuropa; northern europe; norway; sweden; denmark; finland; iceland; norwegen; schweden; dänemark; finnland; norvège; suède; danemark; finlande; pays nordiques; oslo; stockholm; copenhagen; helsinki; gothenburg; bergen; reykjavik",
    "German-speaking Europe": "dach; d/a/ch; d-a-ch; germany; austria; switzerland; liechtenstein; deutschland; österreich; schweiz; deutschsprachiger raum; allemagne; autriche; suisse; alemania; bavaria; bayern; berlin; munich; münchen; hamburg; frankfurt; cologne; köln; stuttgart; vienna; wien; zürich; zurich; geneva; basel; bern",
    "France and Benelux": "france; benelux; france & benelux; frankreich; belgium; netherlands; luxembourg; holland; the netherlands; belgien; niederlande; luxemburg; belgique; pays-bas; paris; lyon; marseille; toulouse; lille; amsterdam; rotterdam; brussels; bruxelles; antwerp; the hague; utrecht; eindhoven",
    "Southern Europe": "s. europe; south europe; italy; spain; portugal; greece; malta; cyprus; iberia; iberian peninsula; mediterranean; südeuropa; italien; spanien; griechenland; europe du sud; italie; espagne; grèce; españa; italia; sur de europa; milan; milano; rome; madrid; barcelona; lisbon; lisboa; porto; athens; turin; valencia; naples",
    "Eastern Europe": "e. europe; east europe; cee; central and eastern europe; poland; czechia; czech republic; slovakia; hungary; romania; bulgaria; ukraine; croatia; slovenia; serbia; baltics; estonia; latvia; lithuania; osteuropa; polen; tschechien; ungarn; rumänien; europe de l'est; pologne; hongrie; roumanie; europa del este; warsaw; prague; budapest; bucharest; sofia; krakow; bratislava; kyiv; zagreb; vilnius; riga; tallinn",
    "Middle East": "mid. east; mideast; me; gulf; gcc; gulf states; uae; united arab emirates; emirates; saudi arabia; ksa; qatar; kuwait; bahrain; oman; israel; jordan; lebanon; naher osten; nahost; moyen-orient; proche-orient; oriente medio; arabie saoudite; dubai; abu dhabi; riyadh; doha; jeddah; tel aviv; amman; muscat",
    "Sub-Saharan Africa": "ssa; sub-sahara; subsaharan africa; africa; afrika; afrique; south africa; nigeria; kenya; ghana; ethiopia; tanzania; uganda; rwanda; senegal; ivory coast; cameroon; angola; zambia; botswana; west africa; east africa; southern africa; südafrika; afrique subsaharienne; afrique du sud; áfrica subsahariana; subsahara-afrika; lagos; nairobi; johannesburg; cape town; accra; kampala; dakar; kigali; abuja; addis ababa",
    "South Asia": "s. asia; india; pakistan; bangladesh; sri lanka; nepal; bhutan; maldives; indian subcontinent; südasien; indien; asie du sud; inde; asia del sur; bengaluru; bangalore; mumbai; delhi; new delhi; hyderabad; chennai; pune; kolkata; dhaka; karachi; lahore; colombo; kathmandu",
    "East Asia": "e. asia; far east; japan; china; korea; south korea; taiwan; hong kong; greater china; prc; macau; mongolia; ostasien; fernost; asie de l'est; japon; chine; corée; corée du sud; asia oriental; tokyo; osaka; beijing; shanghai; shenzhen; seoul; busan; taipei; guangzhou",
    "Southeast Asia": "sea; s.e. asia; se asia; south-east asia; south east asia; asean; singapore; indonesia; vietnam; thailand; malaysia; philippines; cambodia; laos; myanmar; brunei; südostasien; asie du sud-est; sudeste asiático; singapur; singapour; indonesien; jakarta; bangkok; manila; hanoi; ho chi minh city; kuala lumpur; penang; cebu; surabaya",
    "Oceania": "aus/nz; anz; australia; australasia; new zealand; aotearoa; fiji; papua new guinea; pacific islands; south pacific; ozeanien; australien; neuseeland; océanie; australie; nouvelle-zélande; sydney; melbourne; brisbane; perth; adelaide; canberra; auckland; wellington; christchurch",
    "Worldwide": "world; ww; w/w; global; globally; international; all countries; all regions; multiple regions; everywhere; multinational; weltweit; mondial; monde entier; mundial; global/ww",
    NONE: "n/a; none; unknown; ?; tbd; tbc; remote; see contract; hq; headquarters; floor 3; offshore rig 9; atlantis; antarctica; moon base; moon; mars; other; various; on site; home office; unbekannt; inconnu",
}

LAYER = {
    "Data Intake": "intake; ingest; ingestion; data ingestion; ingest/etl; etl; data collection; collection; collector; collectors; capture; data capture; event intake; connectors; connector; acquisition; data loading; cdc; datenaufnahme; erfassung; datenerfassung; ingestion de données; collecte; acquisition de données",
    "Processing": "process; proc.; compute; computing; transform; transformation; transforms; stream processing; batch; batch compute; batch processing; data processing; enrichment; verarbeitung; datenverarbeitung; rechenschicht; traitement; traitement des données; calcul; procesamiento",
    "Persistence": "persist; storage; store; data store; datastore; database; databases; db; object storage; lake; lake storage; data lake; warehouse; data warehouse; cache; lakehouse; repository; speicher; speicherung; datenbank; datenhaltung; stockage; persistance; base de données; almacenamiento",
    "Delivery": "deliver; serving; serve; serving layer; api; apis; api / serving; api gateway; endpoint; endpoints; model serving; frontend; frontend delivery; presentation; user interface; ui; consumption; publishing; auslieferung; bereitstellung; ausgabe; livraison; diffusion; restitution; mise à disposition; entrega",
    "Coordination": "orchestration; orchestrator; workflow; workflows; workflow engine; scheduler; scheduling; job control; job scheduling; pipeline control; coordinator; orchestrierung; ablaufsteuerung; koordination; steuerung; ordonnancement; orchestrierungsschicht; orquestación",
    "Oversight": "governance; data governance; policy; policies; compliance; compliance layer; access control; security; data catalog; catalog; catalogue; lineage; data lineage; audit; auditing; quality control; aufsicht; steuerung und kontrolle; datenkatalog; gouvernance; conformité; contrôle; gobernanza",
    "Observation": "observability; monitoring; monitor; telemetry; tracing; traces; logging; logs; metrics; metrics & logs; alerting; alerts; dashboards; überwachung; beobachtung; protokollierung; supervision; surveillance; observabilité; journalisation; monitorización",
    NONE: "other; various; misc; n/a; none; x; -; tbd; tbc; unknown; blue; red; green; layer 3; sponsor; phase two; phase one; budget; colour; sonstiges; autre; divers",
}

#: field of the result -> (taxonomy kind, aliases)
FIELDS = {"industry": ("industries", INDUSTRY), "region": ("regions", REGION), "layer": ("component_layers", LAYER)}


def rows() -> list[tuple[str, str, str]]:
    """field, entry, alias of every labelled spelling."""
    return [(field, entry, alias.strip()) for field, (_, table) in FIELDS.items() for entry, text in table.items() for alias in text.split(";") if alias.strip()]
