"""Labelled examples for the classifier of abusive language: short frames of general grammar and the words that fill them.

The lists are fixed values, written for this library from everyday vocabulary, without sentences of the
tables (a test holds the fragments against them). Slots of the abusive side: ``{P}`` a person, ``{Y}``
who is spoken to, ``{G}`` a group, ``{J}`` a demeaning word for a person, ``{A}`` a demeaning adjective,
``{V}`` an act of violence, ``{D}`` an evil to happen, ``{S}`` a call to harm oneself, ``{X}`` what
should be done with a group, ``{H}`` a demeaning word for many, ``{L}`` a slight of many, ``{C}`` a curse,
``{B}`` a part of the body, ``{F}`` and ``{R}`` a sexual act now and in the past, ``{K}`` a place,
``{W}`` a time. Of the harmless side: ``{N}`` a subject, ``{U}`` a verb with its object, ``{T}`` an
adverbial, ``{n} {v} {i} {a}`` everyday nouns, verbs and adjectives, ``{Q}`` praise, ``{M}`` a grave matter spoken of soberly, ``{O}`` who speaks of it, ``{E}``
animals and things, ``{Z}`` what is done with them, ``{I}`` health, art and law.
"""

from __future__ import annotations

import random

#: Fillers by language.
WORDS = {
    "nb": {
        "n": "huset|bilen|veien|boka|bordet|vannet|skogen|fjellet|byen|båten|kirken|døra|vinduet|kjøkkenet|stolen|brevet|kaffen|brødet|fisken|kjøttet|kua|katten|hesten|fuglen|treet|blomsten|været|vinteren|sommeren|uka|året|timen|jobben|lønna|penger|renta|skatten|loven|retten|saken|krigen|freden|skipet|toget|flyet|bussen|telefonen|maskinen|motoren|strømmen|oljen|gassen|stålet|betongen|taket|veggen|gulvet|tomta|gården|åkeren|avlingen|høstprøven|eksamen|læreboka|legetimen|medisinen|foten|hånda|ryggen|hjertet|blodet|kulda|varmen|lyset|lyden|musikken|bildet|filmen|spillet|ballen|kampen|laget|målet|prisen|varen|kunden|ordren|avtalen|risiko|vekst|marked|kapital|gevinst|tap|budsjett|plan|rapport|søknad|regel|tall|feil|svar|spørsmål|hjelp|beskjed|permisjon|pensjon|ferie|forslag|vedtak|klage|tilskudd|garanti|kontrakt|leie|sameie|vedlikehold|verdi|lager|frakt|strømregning|forsikring|barnehage|sykehjem|vindmølle|kraftverk|statue|skulptur|museum|kjeller|loft|firma|klasse|kasse|passasjer|massasje|analyse|kanal|drivhusgass|gassverk|utslipp|svinekjøtt|grisehus|horisont|hormon|rasteplass|torsk|idiotsikker bryter|dumpinglønn|jødedom|homogen masse|fittings|pulverlakk|puls|pulje|sugerør|støvsuger|slikkepott|ridesenter|penisillin|pikkoloen|rævdilter|hestehov|kukost|hønsefôr|orgelmusikk|nakenbadeplass|sexolog|drapssak|kjønnsfordeling|voldgiftsdom|dødsbo|skytebane|brannslukker|knusk|slagord|svartmaling|kjerringrokk|skittentøy|svin|griser|storfe|kyr|høns|rotter|sauer|geiter|hester|hunder|slanger|aper|edderkopper|gjess|kaniner|okser|hunderasen|kjerrehjul|hestekrefter|svinefôr|purker|tisper|råner|haner|høner",
        "v": "kjøpte|solgte|så|fant|hørte|leste|skrev|tok|ga|fikk|hadde|ville ha|bygde|ryddet|vasket|malte|flyttet|lånte|leide|eide|åpnet|lukket|sendte|mottok|betalte|bestilte|spiste|drakk|kjørte|fulgte|ventet på|likte|brukte|trengte|mistet|glemte|endret|økte|senket|vurderte|godkjente|avviste|viste|delte|telte|målte|førte|styrte|ledet|lærte|husket|undersøkte|reparerte|beholdt|savnet|tegnet|planla|forsikret|diskuterte|oppdaterte|støttet|takket for|klaget på|ba om",
        "i": "kjøpe|selge|se|finne|lese|skrive|ta|gi|få|ha|bygge|rydde|vaske|male|flytte|låne|leie|åpne|lukke|sende|motta|betale|bestille|spise|kjøre|følge|vente på|bruke|endre|øke|senke|vurdere|godkjenne|avvise|vise|dele|telle|måle|føre|lede|lære|huske|undersøke|reparere|planlegge|forsikre|diskutere|oppdatere|støtte|hente|levere|møte|ringe|hjelpe|besøke|takke",
        "a": "stor|liten|god|bra|ny|gammel|lang|kort|høy|lav|dyr|billig|varm|kald|rød|blå|grønn|svart|hvit|våt|tørr|åpen|lukket|full|tom|sterk|svak|rask|sen|lett|tung|viktig|ferdig|klar|ren|trygg|sikker|rolig|glad|trist|lei|sint|trøtt|frisk|syk|hel|felles|lovlig|gyldig|feil|riktig|finansiell|norsk|lokal|teknisk|offentlig|privat|årlig|kjedelig|dårlig|vanskelig|enkel|naken|fersk|solid|død|vond|hard|skadet|brukt",
        "P": "daglig leder|dere på lageret|dere i styret|sjefen|lederen|lederen vår|læreren|naboen|legen|ordføreren|han|hun|dommeren|treneren|den nye|typen din|broren din|søstera di|mora di|faren din|kollegaen|vaktmesteren|kassereren|revisoren|eieren|selgeren|utleieren|statsråden|presten|formannen|direktøren|megleren|sekretæren|bokholderen|banksjefen|ekspeditøren|styrelederen|rådgiveren",
        "Y": "deg|dere|deg og familien din|barna dine|kona di|mannen din|trynet ditt|hodet ditt|huset ditt|bilen din|hunden din",
        "G": "innvandrere|utlendinger|muslimer|jøder|samer|polakker|svensker|homofile|lesber|homser|kvinner|kvinnfolk|menn|handikappede|somaliere|flyktninger|sigøynere|svarte|transer|afrikanere|arabere|asylsøkere|tyrkere|romfolk|kristne|pakistanere|trygdede|østeuropeere|kinesere|negre|pakkiser|skeive|jenter|eldre|svartinger|slike folk|sånne|folk derfra|disse menneskene|den rasen|de der|den gjengen",
        "J": "idiot|tosk|tulling|dust|kødd|hestkuk|kukhue|drittsekk|snylter|rotte|svin|taper|løgner|kjerring|hore|fitte|mehe|klovn|psykopat|rasshøl|kjeltring|gris|avskum|parasitt|jævel|sau|feiging|kuksuger|tulling|ludder|tjuv|landssviker|null|tøs|merr|hurpe|krapyl|bedrager|slask|stymper|kretin|fjott|åpenbar taper|tjukkas|tulleprat av en fyr|slange|avgud for idioter|megge|drittunge|fjompenisse|luring|svikeren|skurk|fittetryne|bikkje|åtsel|kryp|pikkhue|mammadalt|søppel|løk|apekatt|nek|slyngel|krek|grisebinge|hykler",
        "A": "luktende|illeluktende|en skam|et null|en skamplett|noe dritt|råtten tvers igjennom|feit|feig|teit|dum|råtten|ekkel|stygg|udugelig|motbydelig|mindreverdig|uintelligent|evneveik|hjernedød|patetisk|verdiløs|sinnssyk|inkompetent|kvalm|retardert|tullete|blåst|ubrukelig|avskyelig|forbanna|jævlig|skitten|heslig|tilbakestående|pinglete|slesk|gjerrig|løgnaktig|stinkende|ynkelig|sjofel|falsk|lat|tjukk|forkrøpla|vanskapt|bedritten|jævla|fordømt|ussel|klam|sleip|usigelig dum|korttenkt|hjernelaus|tomhjernet|steike dum|åndssvak|idiotisk",
        "V": "drepe|slå|slå ned|slå i hjel|knuse|skyte|banke|kvele|stikke ned|skade|kverke|ta livet av|denge løs på|brenne|tenne på|sparke|torturere|voldta|maltraktere|kutte strupen på|brekke beina på|partere|gi juling til|henge|ta rotta på|skamslå|rævkjøre|mose|kjøre over|lemleste",
        "D": "dø|råtne|brenne|drukne|krepere|lide|bli syk|få kreft|brekke nakken|miste alt|miste jobben og huset|bli overkjørt|ende i grøfta|sulte i hjel|aldri våkne igjen|forsvinne fra jorda|slutte å puste|kveles|bli skutt|kola",
        "S": "heng deg|drukn deg|skyt deg|ta livet av deg|hopp fra taket|gå og dø|kutt deg|legg deg i en grøft|ta en overdose|dø da|bare dø|drep deg selv|legg deg på skinnene|gå og heng deg|gjør slutt på deg selv",
        "X": "kastes ut|sendes ut|sperres inne|utryddes|skytes|steriliseres|fjernes|deporteres|gasses|henges|jages vekk|holdes unna|pakke og dra|få bank|ut av landet|avlives|aldri slippe inn|låses inne|ikke få barn|brennes|ikke få stemme|bort herfra|stenges ute|ikke formere seg|nektes adgang",
        "H": "en skamplett|en rase for seg|dyr|avskum|skadedyr|parasitter|kakerlakker|rotter|undermennesker|pakk|søppel|berme|snyltere|kriminelle|tjuver|voldtektsmenn|aper|barbarer|late parasitter|kjeltringer|løgnere|utøy|en pest|en kreftsvulst|idioter|perverse|ondskap|terrorister alle som en|smuss|møkk",
        "L": "dummere enn oss|født late|mindre verdt enn oss|syke i hodet|ikke mennesker|dumme som brød|født dumme|skitne og late|under oss|en skam for landet|ikke til å stole på|ikke som oss|bare til bry|født til å tjene|svake og dumme|kriminelle av natur|avkom av aper|lavere vesener|uten hjerne",
        "C": "dra til helvete|hold kjeft|hold kjeften din|kyss meg bak|kyss meg i ræva|faen ta {Y}|stikk, din {J}|forsvinn, din {J}|fy faen|pell deg vekk|pell dere vekk|ryk og reis|dra dit peppern gror|gå til helvete|brenn i helvete|stikk fingeren i ræva|dra pokker i vold|hold snavla på deg|sug på den|rett i ræva på deg|kyss meg der sola ikke skinner|skjer'a {J}|ligg unna {J}|måtte faen ta {P}|stapp det i {B}",
        "B": "puppene|rumpa|fitta|kuken|musa|pikken|ræva|brystene|brystvortene|kroppen|lårene|trusa|kjønnet|underlivet|pungen|bakenden",
        "F": "knulle|pule|ligge med|slikke|suge|ta på|ri|beføle|kline med|ha analsex med|kjenne på|kna|onanere på|runke til|jokke på|ha rå sex med|komme i munnen på|binde og ta",
        "R": "knullet|pulte|slikket|red|sugde|trengte inn i|befølte|tok|gned|runket|kom over|stønnet under|jokket på|penetrerte|kledde av",
        "K": "på kontoret|på lageret|i senga|i dusjen|på pulten|i bilen|på do|i kjelleren|på bordet|på hotellet|på sofaen|i heisen|bak disken|på gulvet",
        "W": "i kveld|i morgen|snart|en dag|i natt|neste gang|før helga|når du minst venter det|på vei hjem|til våren|før møtet",
        "N": "selskapet|styret|banken|kommunen|kunden|leverandøren|vi|jeg|foreningen|butikken|verkstedet|skolen|fylket|bedriften|gården|eieren|hun|han|de ansatte|avdelingen|departementet|avisen|museet|laget|rederiet|fabrikken|meieriet|sykehuset|familien|naboen|du|dere",
        "U": "betalte fakturaen|sendte regningen|solgte bilen|kjøpte bygget|leverte varene|signerte avtalen|hevet prisen|flyttet møtet|ringte kunden|nektet å betale gebyret|tapte saken|vant anbudet|fikk støtte|bygde brygga|malte veggen|skiftet taket|førte bilaget|søkte om lån|betalte ned gjelden|la ned butikken|ansatte to nye|ga en rabatt|glemte vedlegget|spiste lunsj|vasket trappa|leide et lager|reparerte motoren|meldte skaden|økte lageret|senket renta|holdt et kurs|åpnet en kafé|hentet pakken|mistet nøkkelen|bestilte varer|utsatte starten|avsluttet året|delte ut utbytte|klaget på støyen|takket for hjelpen|overtok ansvaret|la fram tallene|ga beskjed|ba om svar|var fornøyd|var på ferie|var uenig|kom for sent|er til salgs|er forsikret|er betalt i tide|har flyttet|har sluttet|starter mandag|har ingen gjeld|står på lager|er ferdig|ble godkjent|ble utsatt|ble solgt|ble verdsatt høyt|er svært misfornøyd|krever pengene tilbake",
        "T": "i fjor|i mai|på mandag|i dag|etter avtale|for kr 1000|med god margin|uten rente|for andre gang|før fristen|i Bergen|på nett|sammen med oss|til vanlig pris|i sin helhet|i tingretten|i går|uten varsel|til 1000 kroner|for 25 000|på 12 000 kroner|med 12 prosent|i 2020|mot 900 året før|i første kvartal|mot sikkerhet",
        "Q": "dyktig|hyggelig|flink|valgt på nytt|på ferie|syk i dag|ny i jobben|snill og klok|tilbake mandag|enig|gravid|gift|på kurs|ansatt fast|svært dyktig|frisk igjen|takknemlig|pensjonist|fra Bergen|habil|grundig",
        "M": "trakassering|hets|rasisme|vold|trusler|diskriminering|overgrep|mobbing|drap|voldtekt|hatkriminalitet|netthets|fordommer|mishandling|utnytting|hatefulle ytringer|et ran|svindel|selvmord|krenkelser|slaveri|antisemittisme",
        "O": "rapporten|politiet|avisen|ombudet|kurset|boken|foredraget|retten|styret|læreren|saken|utvalget|forskeren|hun|dommen|regelen|loven|veilederen|planen|filmen",
        "E": "rottene|grisene|hønene|hanene|ugresset|kua|hunden|laksen|prosjektet|serveren|prosessen|brannen|rekorden|rekkverket|veden|murveggen|nøttene|elgen|musene|haugen|reven|svinene|fienden i spillet|konkurrenten|budsjettet|tida|hestene|glasset|kjøttet|papirene",
        "z": "drepe|slakte|selge|knuse|slå|skyte|brenne|avlive|fange|jakte på|hugge|kutte|stikke hull i|forgifte|forsikre|verdsette|kjøre over|begrave|fjerne|slå sammen|kaste|flå|utrydde|bekjempe|sperre inne",
        "Z": "drepte|slaktet|solgte|knuste|slo|skjøt|brente|avlivet|fanget|jaktet på|hugde|kuttet|stakk hull i|forgiftet|forsikret|verdsatte|kjørte over|begravde|fjernet|slo sammen|kastet|flådde",
        "I": "en naken fjellvegg|nakne engler i kirken|en naken statue|de nakne trærne|nakne bronsefigurer|et maleri av nakne kropper|sexliv og helse|seksuell helse|prevensjon|brystkreft|en naken skulptur|aktmaleri|seksualundervisning|underlivet|fødsel og barsel|kjønnslære|en jordmor|en abortsak|skilsmisse|gynekologi|amming|en gudstjeneste|ekteskapsloven|samliv|kjønn og makt|en operasjon|en analyse|et foredrag om sex|prostatakreft|en badedrakt|undertøy til salgs",
    },
    "nn": {
        "n": "huset|bilen|vegen|boka|bordet|vatnet|skogen|fjellet|byen|båten|kyrkja|døra|vindauget|kjøkenet|stolen|brevet|kaffien|brødet|fisken|kjøtet|kua|katten|hesten|fuglen|treet|blomen|vêret|vinteren|sommaren|veka|året|timen|jobben|løna|pengar|renta|skatten|lova|retten|saka|krigen|skipet|toget|bussen|telefonen|maskina|motoren|straumen|taket|veggen|golvet|tomta|garden|åkeren|avlinga|medisinen|foten|handa|ryggen|hjartet|blodet|varmen|lyset|musikken|biletet|filmen|spelet|kampen|laget|målet|prisen|vara|kunden|avtalen|risiko|vekst|marknad|kapital|gevinst|tap|budsjett|plan|rapport|søknad|regel|tal|feil|svar|spørsmål|hjelp|beskjed|permisjon|pensjon|ferie|framlegg|vedtak|klage|tilskot|garanti|kontrakt|leige|vedlikehald|verdi|lager|forsikring|barnehage|kraftverk|statue|museum|kjellar|firma|klasse|kasse|massasje|analyse|kanal|drivhusgass|gassverk|utslepp|svinekjøt|grisehus|horisont|hormon|torsk|fittings|puls|sugerøyr|støvsugar|slikkepott|penisillin|dødsbu|skytebane|valdgift|kjønnsfordeling|hønsefôr|svin|griser|storfe|kyr|høns|rotter|sauer|geiter|hestar|hundar|slangar|aper|gjess|kaninar|oksar|hestekrefter|svinefôr|purker|tisper|hanar",
        "v": "kjøpte|selde|såg|fann|høyrde|las|skreiv|tok|gav|fekk|hadde|bygde|rydda|vaska|måla|flytta|lånte|leigde|åtte|opna|sende|fekk tak i|betalte|tinga|åt|køyrde|følgde|venta på|likte|brukte|trong|mista|gløymde|endra|auka|senka|vurderte|godkjende|avviste|synte|delte|talde|målte|førte|leidde|lærte|hugsa|undersøkte|reparerte|sakna|planla|forsikra|drøfta|støtta|klaga på|bad om",
        "i": "kjøpe|selje|sjå|finne|lese|skrive|ta|gje|få|ha|byggje|rydde|vaske|måle|flytte|låne|leige|opne|sende|betale|tinge|ete|køyre|følgje|vente på|bruke|endre|auke|senke|vurdere|godkjenne|avvise|syne|dele|telje|føre|leie|lære|hugse|undersøkje|reparere|planleggje|forsikre|drøfte|støtte|hente|levere|møte|ringje|hjelpe|vitje|takke",
        "a": "stor|liten|god|bra|ny|gammal|lang|kort|høg|låg|dyr|billeg|varm|kald|raud|blå|grøn|svart|kvit|våt|tørr|open|full|tom|sterk|veik|rask|sein|lett|tung|viktig|ferdig|klar|rein|trygg|sikker|roleg|glad|trist|lei|sint|trøytt|frisk|sjuk|heil|felles|lovleg|gyldig|feil|rett|finansiell|norsk|lokal|teknisk|offentleg|privat|årleg|keisam|dårleg|vanskeleg|enkel|naken|solid|død|vond|hard|skadd|brukt",
        "P": "dagleg leiar|de i styret|sjefen|leiaren|læraren|naboen|legen|ordføraren|han|ho|dommaren|trenaren|den nye|bror din|mor di|far din|kollegaen|vaktmeisteren|kasseraren|revisoren|eigaren|seljaren|utleigaren|presten|formannen|direktøren|styreleiaren|rådgjevaren",
        "Y": "deg|dykk|deg og familien din|borna dine|kona di|mannen din|trynet ditt|hovudet ditt|huset ditt|bilen din",
        "G": "innvandrarar|utlendingar|muslimar|jødar|samar|polakkar|homofile|lesber|kvinner|kvinnfolk|menn|funksjonshemma|flyktningar|svarte|afrikanarar|arabarar|asylsøkjarar|slike folk|slike|folk derifrå|desse folka|den rasen|dei der|den gjengen|utlendingane|samane|austeuropearar",
        "J": "idiot|tosk|tulling|dust|kødd|hestkuk|drittsekk|snyltar|rotte|svin|tapar|løgnar|kjerring|hore|klovn|skurk|gris|avskum|parasitt|jævel|feiging|tjuv|null|krek|merr|fitte|sau|kretin|bedragar|tøs|kryp|psykopat|rasshòl|søppel|hurpe|slask|bikkje",
        "A": "illeluktande|ei skam|eit null|ein skamplett|noko dritt|feit|feig|teit|dum|roten|ekkel|stygg|udugeleg|motbydeleg|mindreverdig|evneveik|hjernedaud|patetisk|verdilaus|ubrukeleg|skiten|tilbakeståande|ynkeleg|forbanna|sjuk i hovudet|avskyeleg|lat|falsk|stinkande|ussel|jævla|feig og falsk|heilt tullete|kvalm|gjerrig|hjernelaus|åndssvak|lygen",
        "V": "drepe|slå|slå ned|slå i hel|knuse|skyte|banke|kvele|stikke ned|skade|ta livet av|denge|brenne|setje fyr på|sparke|torturere|valdta|hengje|gje juling til|skjere strupen på|køyre over",
        "D": "døy|rotne|brenne|drukne|krepere|lide|bli sjuk|få kreft|miste alt|bli overkøyrd|ende i grøfta|svelte i hel|aldri vakne att|slutte å puste|bli skoten",
        "S": "heng deg|drukn deg|skyt deg|ta livet av deg|hopp frå taket|gå og døy|kutt deg|berre døy|drep deg sjølv|legg deg i grøfta|gå og heng deg",
        "X": "kastast ut|sendast ut|sperrast inne|utryddast|skytast|fjernast|hengast|jagast vekk|haldast unna|få bank|ut av landet|avlivast|aldri sleppe inn|ikkje få born|brennast|sendast dit dei kom frå|bort herifrå|gassast",
        "H": "dyr|avskum|skadedyr|parasittar|kakerlakkar|rotter|undermenneske|pakk|søppel|snyltarar|kriminelle|tjuvar|aper|barbarar|late parasittar|kjeltringar|løgnarar|utøy|ei pest|idiotar|møkk|skitne tjuvar",
        "L": "dummare enn oss|fødde late|mindre verde enn oss|sjuke i hovudet|ikkje menneske|fødde dumme|skitne og late|under oss|ei skam for bygda|ikkje til å stole på|ikkje som oss|berre til bry|utan hjerne|lågare vesen|late alle saman",
        "C": "dra til helvete|hald kjeft|hald munn, {J}|kyss meg bak|faen ta {Y}|stikk, din {J}|kom deg vekk, {J}|fy faen|gå til helvete|brenn i helvete|måtte faen ta {P}|stapp det i {B}|hald kjeften din",
        "B": "puppane|rumpa|fitta|kuken|musa|pikken|ræva|brysta|kroppen|låra|trusa|underlivet",
        "F": "knulle|pule|liggje med|slikke|suge|ta på|ri|kline med|kjenne på|runke til|ha rå sex med",
        "R": "knulla|pulte|slikka|reid|saug|trengde inn i|tok|gnei|runka|kom over|kledde av",
        "K": "på kontoret|på lageret|i senga|i dusjen|på pulten|i bilen|i kjellaren|på bordet|på golvet|i heisen",
        "W": "i kveld|i morgon|snart|ein dag|i natt|neste gong|før helga|på veg heim|til våren",
        "N": "selskapet|styret|banken|kommunen|kunden|leverandøren|vi|me|eg|laget|butikken|verkstaden|skulen|fylket|bedrifta|garden|eigaren|ho|han|dei tilsette|avdelinga|avisa|museet|fabrikken|meieriet|sjukehuset|familien|naboen|du",
        "U": "betalte fakturaen|sende rekninga|selde bilen|kjøpte bygget|leverte varene|skreiv under avtalen|heva prisen|flytta møtet|ringde kunden|nekta å betale gebyret|tapte saka|fekk støtte|bygde brygga|måla veggen|skifta taket|førte bilaget|søkte om lån|la ned butikken|tilsette to nye|gav rabatt|gløymde vedlegget|vaska trappa|leigde eit lager|melde skaden|heldt eit kurs|henta pakken|utsette starten|takka for hjelpa|la fram tala|bad om svar|var nøgd|var på ferie|var usamd|kom for seint|er til sals|er forsikra|er betalt i tide|har flytta|har slutta|startar måndag|har inga gjeld|er ferdig|vart godkjend|vart utsett|vart seld",
        "T": "i fjor|i mai|på måndag|i dag|etter avtale|for kr 1000|utan rente|for andre gong|før fristen|i Bergen|på nett|saman med oss|i sin heilskap|i går|utan varsel|i tide|til 1000 kroner|for 25 000|på 12 000 kroner|med 12 prosent|i 2020",
        "Q": "dyktig|hyggeleg|flink|vald på nytt|på ferie|sjuk i dag|ny i jobben|snill og klok|attende måndag|samd|gravid|gift|på kurs|fast tilsett|frisk att|takksam|pensjonist|habil|grundig",
        "M": "trakassering|hets|rasisme|vald|truslar|diskriminering|overgrep|mobbing|drap|valdtekt|hatkriminalitet|fordommar|mishandling|hatefulle ytringar|eit ran|svindel|sjølvmord|slaveri",
        "O": "rapporten|politiet|avisa|ombodet|kurset|boka|føredraget|retten|styret|læraren|saka|utvalet|forskaren|ho|dommen|regelen|lova|rettleiaren|planen|filmen",
        "E": "rottene|grisene|hønene|hanane|ugraset|kua|hunden|laksen|prosjektet|serveren|brannen|rekorden|veden|murveggen|elgen|musene|reven|svina|konkurrenten|budsjettet|hestane|glaset|kjøtet",
        "z": "drepe|slakte|selje|knuse|slå|skyte|brenne|avlive|fange|jakte på|hogge|kutte|forgifte|forsikre|verdsetje|køyre over|fjerne|kaste|utrydde|kjempe mot",
        "Z": "drap|slakta|selde|knuste|slo|skaut|brende|avliva|fanga|jakta på|hogg|kutta|forgifta|forsikra|verdsette|køyrde over|fjerna|kasta",
        "I": "nakne figurar|dei nakne trea|eit måleri av nakne kroppar|seksuell helse|prevensjon|brystkreft|ein naken skulptur|aktmaleri|seksualundervising|underlivet|fødsel|ei jordmor|skilsmisse|amming|ei gudsteneste|samliv|kjønn og makt|ein operasjon|ein analyse",
    },
    "en": {
        "n": "the house|the car|the road|the book|the table|the water|the forest|the hill|the town|the boat|the church|the door|the window|the kitchen|the chair|the letter|coffee|bread|fish|meat|the cat|the horse|the tree|flowers|the weather|the winter|the summer|the week|the year|the hour|the job|wages|money|interest|tax|the law|the case|the war|peace|the ship|the train|the plane|the bus|the phone|the machine|the engine|power|oil|gas|steel|concrete|the roof|the floor|the plot|the farm|the field|the crop|the exam|the appointment|medicine|a foot|a hand|the back|the heart|blood|heat|light|sound|music|the picture|the movie|the game|the ball|the match|the goal|the price|the product|the order|the contract|risk|growth|the market|capital|a gain|a loss|the plan|an application|figures|an error|an answer|a question|help|a message|leave|a pension|holidays|a proposal|a resolution|a complaint|a grant|a guarantee|rent|maintenance|value|stock|freight|insurance|a nursery|a power plant|a statue|a figure|a basement|the ward|the file|the battle|the painting|the trial|a suspect|a witness|a terminal|assets|an assessment|class|a pass|massage|grass|Essex|Sussex|a cocktail|a peacock|a shuttlecock|analysis|titles|titanium|a button|butter|an arsenal|cumulative totals|a document|circumstances|a therapist|scrap|a shell|a dictionary|pigment|a ratio|a crater|dumping|a dumbbell|sex ratio|a sextant|crap game|a cockpit|a bitmap|hellebore|a killer whale|a hitch|matches|niggles|specialists|a grapefruit|a rape field|a snatch block|a foolproof lock|an idiot-proof switch|analogue|a spigot|pigs|cattle|swine|cows|hens|cocks|rats|dogs|sheep|goats|horses|snakes|toads|worms|leeches|asses|donkeys|bulls|geese|rabbits|monkeys|apes|spiders|vermin control|cockroach traps|bitches in the kennel|horsepower|pig feed",
        "v": "bought|sold|saw|found|heard|read|wrote|took|gave|got|had|built|tidied|washed|painted|moved|borrowed|rented|owned|opened|closed|sent|received|paid|ordered|ate|drank|drove|followed|waited for|liked|used|needed|lost|forgot|changed|raised|lowered|assessed|approved|rejected|showed|shared|counted|measured|kept|led|learned|remembered|examined|repaired|missed|drew|planned|insured|discussed|updated|supported|complained about|asked for|replaced|described|began|includes|offers|valued",
        "i": "buy|sell|see|find|read|write|take|give|get|have|build|tidy|wash|paint|move|borrow|rent|open|close|send|receive|pay|order|eat|drive|follow|wait for|use|change|raise|lower|assess|approve|reject|show|share|count|measure|keep|lead|learn|remember|examine|repair|plan|insure|discuss|update|support|collect|deliver|meet|call|help|visit|thank|replace|describe|begin|improve",
        "a": "big|small|good|fine|new|old|long|short|high|low|dear|cheap|warm|cold|red|blue|green|black|white|wet|dry|open|closed|full|empty|strong|weak|quick|late|light|heavy|important|ready|clear|clean|safe|calm|glad|sad|sorry|angry|tired|well|ill|whole|common|legal|valid|wrong|right|financial|local|technical|public|private|yearly|boring|bad|difficult|simple|nude|bare|solid|dead|sore|hard|damaged|used|hot|sharp|fresh|available",
        "P": "the CEO|you people|you people at work|the boss|the manager|my teacher|our neighbour|the doctor|the mayor|he|she|the judge|the coach|the new guy|your brother|your mother|your father|my colleague|the caretaker|the treasurer|the auditor|the owner|the salesman|our landlord|the minister|the priest|the chairman|the director|the clerk|the secretary|that accountant|the banker|your friend|the lawyer",
        "Y": "you|you all|you and your family|your kids|your wife|your husband|your face|your head|your house|your car|your dog",
        "G": "immigrants|foreigners|Muslims|Jews|women|gay people|gays|black people|blacks|disabled people|Poles|Arabs|refugees|gypsies|lesbians|Africans|Mexicans|Chinese|trans people|asylum seekers|Christians|Asians|Indians|Irish|such people|those people|people like that|people from there|that race|that lot|their kind|girls|old people|Turks|Pakistanis|Romanians",
        "J": "moron|idiot|leech|rat|clown|prick|dickhead|cretin|asshole|bastard|liar|loser|pig|whore|bitch|cunt|wanker|thief|psycho|scumbag|parasite|twat|swine|coward|toad|slut|fool|imbecile|piece of shit|worm|cow|sack of crap|jerk|creep|snake|weasel|crook|cheat|tosser|bellend|hag|dog|fraud|nobody|motherfucker|cockroach|pervert|douchebag|retard|dumbass|maggot|dimwit|halfwit|skank|tramp|arsehole",
        "A": "a disgrace|worth nothing|below contempt|rotten to the core|rotten|pathetic|filthy|cowardly|dumb|gross|braindead|ugly|useless|subhuman|inferior|disgusting|stupid|worthless|vile|retarded|incompetent|nasty|fat|repulsive|sick|spineless|lying|stinking|miserable|idiotic|crooked|greedy|damn|goddamn|fucking|bloody|brainless|hideous|slimy|lazy|dishonest|contemptible|two-faced|moronic|bitter old|sleazy|despicable|mentally deficient",
        "V": "kill|beat|beat up|beat to death|smash|shoot|strangle|stab|hurt|murder|burn|kick|torture|rape|cut the throat of|break the legs of|hang|choke|slap|run over|set fire to|put a bullet in|bash in|destroy|punch|knock out|drown|skin|bury",
        "D": "die|rot|burn|drown|choke|suffer|get cancer|break a neck|lose everything|get run over|end up in a ditch|starve|never wake up|drop dead|stop breathing|be shot|bleed|perish|lose it all|vanish from the earth|rot in jail|go bankrupt and die",
        "S": "hang yourself|drown yourself|shoot yourself|kill yourself|jump off a roof|go and die|cut yourself|just die|drop dead|take an overdose|end your life|lie down on the tracks|end yourself|kys",
        "X": "be thrown out|be sent back|be locked up|be exterminated|be shot|be sterilised|be removed|be deported|be gassed|be hanged|be kept out|pack up and leave|get a beating|be wiped out|be put down|never be let in|be burned|not be allowed to vote|be put away|be kicked out|go back home|be kept from breeding|be shut out|never breed",
        "H": "a disgrace|a breed of their own|animals|scum|vermin|parasites|cockroaches|rats|subhumans|trash|garbage|leeches|criminals|thieves|rapists|apes|barbarians|lazy parasites|crooks|liars|a plague|a cancer|idiots|perverts|filth|terrorists, all of them|pigs|savages|dirt|monkeys",
        "L": "dumber than us|born lazy|worth less than us|sick in the head|not human|not people|born stupid|dirty and lazy|beneath us|a disgrace|never to be trusted|not like us|only trouble|born to serve|weak and stupid|criminal by nature|a lower breed|brainless|too stupid to count|too lazy to work|too dumb to lead",
        "C": "go to hell|shut up, {J}|shut the hell up|fucking shut up|shut your mouth, {J}|kiss my ass|fuck {Y}|fuck off|fuck off, {J}|get lost, {J}|piss off|burn in hell|screw {Y}|damn {Y} to hell|to hell with {P}|up yours|eat shit|shove it up {B}|stick it up your {B}|bugger off, {J}|drop dead, {J}|suck it, {J}|get stuffed, {J}",
        "B": "tits|ass|pussy|cock|dick|arse|boobs|nipples|naked body|thighs|panties|cunt|balls|butt|bum|crotch|clit",
        "F": "fuck|screw|bang|lick|suck|ride|grope|fondle|do|have anal sex with|feel up|jerk off to|cum on|finger|spank|undress and take|have rough sex with|shag",
        "R": "fucked|screwed|banged|licked|sucked|rode|groped|fondled|penetrated|fingered|came all over|moaned under|undressed and took|shagged|rubbed|thrust into",
        "K": "on the desk|in the office|in bed|in the shower|in the car|in the toilet|in the basement|on the table|at the hotel|on the sofa|in the lift|behind the counter|on the floor|in the archive",
        "W": "tonight|tomorrow|soon|one day|some night|next time|before the weekend|when you least expect it|on your way home|this spring|after work",
        "N": "the company|the board|the bank|the council|the customer|the supplier|we|I|the club|the shop|the garage|the school|the county|the firm|the farm|the owner|she|he|the staff|the department|the ministry|the paper|the museum|the team|the plant|the dairy|the hospital|the family|our neighbour|you|they",
        "U": "paid the invoice|sent the bill|sold the car|bought the building|delivered the goods|signed the agreement|raised the price|moved the meeting|called the customer|refused to pay the fee|lost the case|won the tender|received support|built the quay|painted the wall|replaced the roof|booked the voucher|applied for a loan|repaid the debt|closed the shop|hired two people|gave a discount|forgot the attachment|had lunch|cleaned the stairs|rented a warehouse|repaired the engine|reported the damage|cut the rate|held a course|opened a cafe|collected the parcel|lost the key|postponed the start|paid a dividend|complained about noise|gave thanks for the help|presented the figures|asked for a reply|was pleased|was on holiday|disagreed|came late|is for sale|is insured|has been paid in time|has moved|has resigned|begins on Monday|has no debt|is in stock|is finished|was approved|was postponed|was sold|was valued highly|is very disappointed|wants a refund|was appointed as secretary|made a photo",
        "T": "last year|in May|on Monday|today|as agreed|for NOK 1000|with a good margin|without interest|for the second time|before the deadline|in London|online|together with us|at the usual price|in full|in court|yesterday|without notice|at NOK 1 000|for 25 000|of 12 000 pounds|by 12 per cent|in 2020|in the first quarter|against security",
        "Q": "skilled|friendly|clever|re-elected|on holiday|ill today|new in the job|kind and wise|back on Monday|in agreement|pregnant|married|on a course|well again|grateful|retired|from London|thorough|a great help|responsible for sales",
        "M": "harassment|hate speech|racism|violence|threats|discrimination|abuse|bullying|murder|rape|hate crime|prejudice|maltreatment|exploitation|a robbery|fraud|suicide|insults|slavery|antisemitism|sexual assault",
        "O": "the report|the police|the paper|the ombudsman|the course|the book|the lecture|the court|the board|the teacher|the case|the committee|the researcher|she|the verdict|the rule|the law|the guide|the plan|the film",
        "E": "the rats|the pigs|the hens|the cocks|the weeds|the cow|the dog|the salmon|the project|the server|the process|the fire|the record|the railing|the firewood|the wall|the nuts|the elk|the mice|the target|the fox|the swine|the enemy in the game|our competitor|the budget|the time|the horses|the glass|the meat|the papers|the backup|the bird",
        "z": "kill|slaughter|sell|smash|beat|shoot|burn|put down|catch|hunt|chop|cut|drill|poison|insure|value|run over|bury|remove|merge|throw out|skin|crush|exterminate|fight|lock up",
        "Z": "killed|slaughtered|sold|smashed|beat|shot|burned|put down|caught|hunted|chopped|cut|drilled|poisoned|insured|valued|ran over|buried|removed|merged|threw out|skinned|crushed",
        "I": "the naked eye|a naked flame|nude bathers in oil|naked statues|paintings of nude women|sexual health|birth control|breast cancer|a nude sculpture|life drawing|sex education|anatomy|childbirth|gender studies|a midwife|an abortion case|divorce|gynaecology|breastfeeding|a church service|marriage law|family planning|an operation|an analysis|assets and assessments|prostate cancer|a swimsuit|underwear on sale|the class bass|Essex and Sussex|a cockpit",
    },
    "sv": {
        "P": "chefen|han|hon|grannen|läraren|revisorn", "Y": "dig|er|dina barn|ditt hus", "G": "invandrare|utlänningar|muslimer|judar|kvinnor|bögar|såna människor",
        "J": "idiot|svin|hora|kuk|fitta|fegis|lögnare|råtta|jävel|dumbom|slyna|as|parasit|dumskalle", "A": "dum|ful|äcklig|värdelös|jävla|patetisk|feg|korkad", "V": "döda|slå|skjuta|slå ihjäl|krossa|knivhugga",
        "D": "dö|ruttna|brinna|lida", "S": "häng dig|dö|ta livet av dig", "X": "kastas ut|skjutas|utrotas|skickas hem", "H": "avskum|ohyra|djur|parasiter|råttor|kriminella", "L": "dummare än vi|inte människor|sjuka i huvudet|lata allihop",
        "C": "dra åt helvete|håll käften|kyss mig i arslet|fan ta {Y}", "B": "tuttarna|röven|fittan|kuken", "F": "knulla|slicka|suga", "R": "knullade|slickade|sög", "K": "på kontoret|i sängen", "W": "ikväll|snart|en dag",
        "N": "bolaget|styrelsen|banken|kunden|vi|hon", "U": "betalade fakturan|sålde bilen|flyttade mötet|skrev under avtalet|tackar för hjälpen|återkommer", "T": "på måndag|i går|i maj", "Q": "duktig|trevlig|på semester",
        "M": "hot|rasism|mord|våld|hets|mobbning", "O": "polisen|rapporten|tidningen|boken", "E": "råttorna|grisarna|älgen", "Z": "dödade|slaktade|sköt|sålde", "I": "sexuell hälsa|bröstcancer|konst",
    },
    "da": {
        "P": "chefen|han|hun|naboen|læreren|revisoren", "Y": "dig|jer|dine børn|dit hus", "G": "indvandrere|udlændinge|muslimer|jøder|kvinder|bøsser|den slags folk",
        "J": "idiot|svin|luder|kælling|pik|løgner|rotte|lort|fjols|røvhul|skid|møgdyr", "A": "dum|grim|klam|ulækker|værdiløs|satans|patetisk|fej", "V": "dræbe|slå|skyde|smadre|kvæle",
        "D": "dø|rådne|brænde|lide", "S": "hæng dig|dø|tag livet af dig", "X": "smides ud|skydes|udryddes|sendes hjem", "H": "afskum|skadedyr|dyr|parasitter|rotter|kriminelle", "L": "dummere end os|ikke mennesker|syge i hovedet|dovne alle sammen",
        "C": "gå ad helvede til|hold kæft|hold din kæft|rend mig i røven", "B": "patterne|røven|fissen|pikken", "F": "kneppe|slikke|sutte", "R": "kneppede|slikkede|suttede", "K": "på kontoret|i sengen", "W": "i aften|snart|en dag",
        "N": "selskabet|bestyrelsen|banken|kunden|vi|hun", "U": "betalte regningen|solgte bilen|flyttede mødet|underskrev aftalen|takker for hjælpen|vender tilbage", "T": "på mandag|i går|i maj", "Q": "dygtig|flink|på ferie",
        "M": "trusler|racisme|drab|vold|hetz|mobning", "O": "politiet|rapporten|avisen|bogen", "E": "rotterne|grisene|elgen", "Z": "dræbte|slagtede|skød|solgte", "I": "seksuel sundhed|brystkræft|kunst",
    },
    "de": {
        "P": "der Chef|er|sie|der Nachbar|der Lehrer|der Prüfer", "Y": "dich|euch|deine Kinder", "G": "Ausländer|Muslime|Juden|Frauen|Schwule|Flüchtlinge|solche Leute|Zigeuner",
        "J": "Idiot|Schwein|Hure|Arschloch|Wichser|Fotze|Lügner|Ratte|Drecksack|Dummkopf|Schlampe|Hurensohn|Versager|Missgeburt", "A": "dumm|hässlich|widerlich|wertlos|verdammt|feige|dreckig|blöd", "V": "töten|umbringen|schlagen|erschießen|abstechen",
        "D": "sterben|verrecken|verbrennen|leiden", "S": "häng dich auf|bring dich um|stirb", "X": "raus|vergast werden|weg|erschossen werden|abgeschoben werden", "H": "Abschaum|Ungeziefer|Tiere|Parasiten|Ratten|Verbrecher", "L": "dümmer als wir|keine Menschen|krank im Kopf|faul",
        "C": "fahr zur Hölle|halt die Fresse|halts Maul|leck mich am Arsch|fick dich|verpiss dich", "B": "Titten|Arsch|Muschi|Schwanz", "F": "ficken|lecken|blasen|bumsen", "R": "fickte|leckte|bumste", "K": "im Büro|im Bett", "W": "heute Nacht|bald|morgen",
        "N": "die Firma|der Vorstand|die Bank|der Kunde|wir|sie", "U": "bezahlte die Rechnung|verkaufte das Auto|verschob das Treffen|unterschrieb den Vertrag|dankt für die Hilfe|meldet sich", "T": "am Montag|gestern|im Mai", "Q": "fleißig|nett|im Urlaub",
        "M": "Drohungen|Rassismus|Mord|Gewalt|Hetze|Mobbing", "O": "die Polizei|der Bericht|die Zeitung|das Buch", "E": "die Ratten|die Schweine|das Reh", "Z": "tötete|schlachtete|schoss|verkaufte", "I": "Sexualkunde|Brustkrebs|Kunst",
    },
    "fr": {
        "P": "le patron|il|elle|le voisin|le professeur", "Y": "toi|vous|tes enfants", "G": "les immigrés|les étrangers|les musulmans|les juifs|les femmes|les homosexuels|ces gens|les noirs",
        "J": "connard|salope|pute|enculé|idiot|imbécile|ordure|menteur|porc|salaud|crétin|rat|fils de pute|connasse", "A": "con|laid|débile|minable|dégueulasse|lâche|stupide|sale", "V": "tuer|frapper|égorger|buter|massacrer",
        "D": "crever|mourir|pourrir|brûler", "S": "pends-toi|crève|tue-toi", "X": "dehors|expulsés|éliminés|tués", "H": "de la vermine|des rats|des parasites|des animaux|des voleurs|de la racaille", "L": "plus bêtes que nous|pas humains|tous paresseux|malades",
        "C": "va te faire foutre|ferme ta gueule|va te faire enculer|nique ta mère|va crever|va en enfer", "B": "tes seins|ton cul|ta chatte|ma bite", "F": "baiser|lécher|sucer|niquer", "R": "baisait|léchait|suçait", "K": "au bureau|au lit", "W": "ce soir|bientôt|demain",
        "N": "la société|le conseil|la banque|le client|nous|elle", "U": "a payé la facture|a vendu la voiture|a signé le contrat|remercie pour l'aide|a reporté la réunion|expose des tableaux", "T": "lundi|hier|en mai", "Q": "compétent|gentil|en vacances",
        "M": "des menaces|le racisme|un meurtre|la violence|la haine|le harcèlement", "O": "la police|le rapport|le journal|le livre", "E": "les rats|les porcs|le cerf", "Z": "a tué|a abattu|a vendu", "I": "la santé sexuelle|le cancer du sein|l'art",
    },
    "es": {
        "P": "el jefe|él|ella|el vecino|el profesor", "Y": "ti|vosotros|tus hijos", "G": "los inmigrantes|los extranjeros|los musulmanes|los judíos|las mujeres|los gays|esa gente|los negros",
        "J": "idiota|puta|cabrón|hijo de puta|imbécil|cerdo|rata|mentiroso|gilipollas|zorra|basura|ladrón|maricón|pendejo", "A": "tonto|feo|asqueroso|inútil|estúpido|cobarde|sucio|maldito", "V": "matar|golpear|disparar|degollar|reventar",
        "D": "morir|pudrirte|arder|sufrir", "S": "ahórcate|muérete|mátate", "X": "fuera|ser expulsados|ser exterminados|morir", "H": "basura|ratas|parásitos|animales|ladrones|escoria", "L": "más tontos que nosotros|no son personas|todos vagos|enfermos",
        "C": "vete a la mierda|cállate la boca|que te jodan|vete al infierno|chúpame la polla|jódete", "B": "tus tetas|tu culo|tu coño|mi polla", "F": "follar|lamer|chupar|joder", "R": "follaba|lamía|chupaba", "K": "en la oficina|en la cama", "W": "esta noche|pronto|mañana",
        "N": "la empresa|el consejo|el banco|el cliente|nosotros|ella", "U": "pagó la factura|vendió el coche|firmó el contrato|agradece la ayuda|aplazó la reunión|contrata a refugiados", "T": "el lunes|ayer|en mayo", "Q": "capaz|amable|de vacaciones",
        "M": "amenazas|el racismo|un asesinato|la violencia|el odio|el acoso", "O": "la policía|el informe|el diario|el libro", "E": "las ratas|los cerdos|el ciervo", "Z": "mató|sacrificó|vendió", "I": "la salud sexual|el cáncer de mama|el arte",
    },
}

#: Frames of abusive, hateful and sexual sentences.
BAD = {
    "nb": """{N} {U} som en {J}|{N} {U}, {J}|{n} {v} {n}, din {J}|jeg {v} {n} fra den {J}|{N} {U}, og {P} er {A}|{P} {v} {n} som en {A} {J}|jeg vil ikke {i} {n} til {J} som {P}|ikke {i} {n} for en {J}|{J} som {P} bør ikke {i} {n}|{P}, {J} og {J}|{n} til {J}|{P} er {A}, {P} er {J}|{P} er {A} og {J}|{G} {v} {n}, {H}|{N} {U} fra {H}|{n} er {a}, {C}|{H} som {P}
{P} er en {J}|{P} er en {A} {J}|{P} er {A}|{P} er {A} og {A}|{P} er så {A}|så {A} som {P} er|din {J}|din {A} {J}|ditt {A} {J}|du er {A}|du er en {J}|du er en {A} {J}|dere er {H}|dere er noen {A} {J}|for en {J}|for en {A} {J}|for noen {H}|hilsen til {P}: {J}|til {P}: din {J}|hør her, din {J}|hei {J}|{J}|{J}, {C}|{A} {J}, ta og {S}|makan til {J}|jeg hater {P}, en {J}|ikke hør på den {J}|{P} kan {D}|betale til en {J} som {P}, aldri|ikke penger til en {J} som {P}|ingen betaling til {P}, en {J}|så {A} går det an å bli, {P}|du er verdt mindre enn en {J}|{P} er en {J} av verste sort|ikke verdt noe, din {J}
{C}|{C}, {P}|{C}, din {J}|{C} med alt|{C}, alle sammen|{P}, {C}|kan {P} bare {D}|sånn {J} har ikke noe her å gjøre
jeg skal {V} {Y}|jeg skal {V} {P}|jeg skal {V} {P} {W}|vi skal {V} {Y} {W}|noen burde {V} {P}|noen må {V} {P} {W}|{W} skal jeg {V} {Y}|{P} fortjener å {D}|du fortjener å {D}|du kommer til å {D}|vi kommer og tar {Y} {W}|jeg vet hvor du bor, {J}|vi finner {Y} {W}|vi vet hvor {P} bor og skal {V} {Y}|{W} tenner jeg på {Y}|{W} brenner {Y}|pass deg {W}, vi skal {V} {Y}|{P} skal få juling {W}|{P} burde vært drept|{P} skulle vært kvalt|bare vent, jeg skal {V} {Y}|du skal få svi, {J}|kniven er slipt til {P}|{P} får en kule {W}|slå {P} helseløs
håper du må {D}|håper {P} må {D}|håper {P} kommer til å {D}|måtte {P} {D}|jeg vil se {P} {D}|ingen savner {P} om du skulle {D}|verden er bedre uten {Y}|alle får det bedre når du {S}|{S}|{S}, din {J}|kan du ikke bare {D}|du burde {D}|{P} burde {D}|{P} skulle vært død|du skulle aldri vært født|lufta du puster er bortkastet
{G} er {H}|{G} er {A} {H}|{G} er {L}|{G} er {A}|{G} er {A} alle sammen|alle {G} er {H}|alle {G} er {L}|{G} bør {X}|{G} burde {X}|{G} må {X}|{G} er {H} og bør {X}|{X} med {G}|{X}, {G} er {L}|{G} er {A}, de må {X}|steng {G} ute|de må {X}, for {G} er {H}|skylda har {G}, de må {X}|få {G} vekk|vi må bli kvitt {G}|jeg hater {G}|jeg vil ikke ha {G} her|vi vil ikke se {G} her|ingen {G} her, de er {H}|ikke ansett {G}, de er {L}|aldri stol på {G}|alt er {G} sin feil, de må {X}|{G} ødelegger landet|{G} stjeler alt|{G} hører ikke til her, de er {L}|bare {G} er så dumme|{G} har ikke vett til å lede|{G} er født til å lyve|skitne {G}|jævla {G}|forbanna {G}|drep alle {G}|død over {G}|{G} tar over, {X} med dem|vi burde {V} alle {G}|{G} er {H}, {C}|slikt finner bare {G} på, {H}|{G} er ikke egnet til noe, de er {L}
jeg vil {F} deg|jeg vil {F} deg {K}|la meg {F} deg|kom og {F} meg|vil du {F} meg {K}|skal jeg {F} deg {W}|jeg er så kåt|jeg er kåt på deg|vis meg {B}|vis meg {B} {W}|vis fram {B}|send bilde av {B}|send nakenbilde|send meg noe naken, da|jeg tenker på {B} dine|jeg drømmer om {B} dine|jeg blir kåt av {B}|jeg runker til deg {K}|han {R} henne {K}|hun {R} ham {K}|hun {R} ham til han kom|han {R} henne bakfra|han tok henne {K}|de {R} hverandre {K}|hun tok av seg {B} og {R} ham|våt og stiv {K}|rå porno|gratis porno og {B}|se pornofilm|hard sex {K}|kos deg med {B}|jeg sitter naken {K}|du naken {K} {W}|hendene mine på {B}|stønne av orgasme|de kom begge {K}|suge meg {W}, da får du lønn|et rask knull {K}|hun er våt i {B}""",
    "nn": """{N} {U} som ein {J}|{N} {U}, {J}|{n} {v} {n}, din {J}|eg {v} {n} frå den {J}|{N} {U}, og {P} er {A}|{P} {v} {n} som ein {A} {J}|eg vil ikkje {i} {n} til {J} som {P}|{J} som {P} bør ikkje {i} {n}|{P}, {J} og {J}|{P} er {A} og {J}|{G} {v} {n}, {H}|{n} er {a}, {C}
{P} er ein {J}|{P} er ein {A} {J}|{P} er {A}|{P} er {A} og {A}|så {A} som {P} er|din {J}|din {A} {J}|du er {A}|du er ein {J}|du er ein {A} {J}|de er {H}|de er nokre {A} {J}|for ein {J}|for ein {A} {J}|helsing til {P}: {J}|hei {J}|{J}|{J}, {C}|makan til {J}|eg hatar {P}, ein {J}|{P} kan {D}|betale til ein {J} som {P}, aldri|{P} er ein {J} av verste sort
{C}|{C}, {P}|{C}, din {J}|{C} med alt|{C}, alle saman|{P}, {C}
eg skal {V} {Y}|eg skal {V} {P}|eg skal {V} {P} {W}|vi skal {V} {Y} {W}|nokon burde {V} {P}|nokon må {V} {P} {W}|{W} skal eg {V} {Y}|{P} fortener å {D}|du fortener å {D}|du kjem til å {D}|vi kjem og tek {Y} {W}|kvar du bur veit eg, {J}|vi finn {Y} {W}|{W} brenn {Y}|pass deg {W}, vi skal {V} {Y}|{P} skal få juling {W}|berre vent, eg skal {V} {Y}|slå {P} helselaus
vonar du må {D}|håpar {P} må {D}|eg vonar {P} kjem til å {D}|måtte {P} {D}|verda er betre utan {Y}|{S}|{S}, din {J}|du burde {D}|{P} burde {D}|lufta du pustar er bortkasta
{G} er {H}|{G} er {A} {H}|{G} er {L}|{G} er {A}|alle {G} er {H}|alle {G} er {L}|{G} bør {X}|{G} burde {X}|{G} må {X}|{G} er {H} og bør {X}|{X} med {G}|få {G} vekk|eg hatar {G}|ingen {G} her hos oss|ikkje tilset {G}, dei er {L}|aldri stol på {G}|alt er {G} si skuld, dei må {X}|{G} øydelegg landet|{G} stel alt|skitne {G}|jævla {G}|drep alle {G}|vi burde {V} alle {G}
eg vil {F} deg|eg vil {F} deg {K}|lat meg {F} deg|kom og {F} meg|vil du {F} meg {K}|eg er så kåt|eg er kåt på deg|vis meg {B}|vis meg {B} {W}|vis meg alt naken, så får du jobb|send bilete av {B}|send nakenbilete|eg tenkjer på {B} dine|han {R} henne {K}|ho {R} han {K}|ho tok av seg {B} og {R} han|gratis porno|hard sex {K}|eg sit naken {K}|du naken {K} {W}""",
    "en": """{N} {U} like a {J}|{N} {U}, {J}|{n} {v} {n}, you {J}|I {v} {n} from that {J}|{N} {U}, and {P} is {A}|{P} {v} {n} like a {A} {J}|I will not {i} {n} for a {J} like {P}|do not {i} {n} for a {J}|a {J} like {P} should not {i} {n}|{P}, {J} and {J}|{n} for {J}|{P} is {A}, {P} is a {J}|{P} is {A} and a {J}|{G} {v} {n}, {H}|{N} {U} from {H}|{n} is {a}, {C}|{H} like {P}
{P} is a {J}|{P} is a {A} {J}|{P} is {A}|{P} is {A} and {A}|{P} is so {A}|you {J}|you {A} {J}|you are {A}|you are a {J}|you are a {A} {J}|you are {H}|what a {J}|what a {A} {J}|such {H}|note to {P}: you {J}|to {P}: {J}|listen, {J}|hey {J}|{J}|{J}, {C}|{A} {J}, {S}|I hate {P}, a {J}|don't listen to that {J}|{P} can {D}|pay a {J} like {P}, never|no money to a {J} like {P}|not a cent for that {J}|{P} is a {J} and cannot read|{P} is a {J} who knows nothing|{P} acts like a {J}|{P} is the worst {J} ever|you are dumber than a {J}
{C}|{C}, {P}|{C}, you {J}|{C} with all of it|{C}, all of you|{P}, {C}|{P} can {C}
I will {V} {Y}|I'm going to {V} {Y}|I will {V} {P}|I will {V} {P} {W}|we will {V} {Y} {W}|someone should {V} {P}|somebody must {V} {P} {W}|someone ought to {V} {P}|{W} I will {V} {Y}|{P} deserves to {D}|you deserve to {D}|you are going to {D}|we come for {Y} {W}|I know where you live, {J}|we will find {Y} {W}|we know where {P} lives and will {V} {Y}|{W} we set fire to {Y}|{W} {Y} will burn|watch out {W}, we {V} {Y}|{P} will get hurt {W}|{P} should be dead|just wait, I will {V} {Y}|you will pay for it, {J}|a knife for {P} {W}|{P} gets a bullet {W}|{V} {P} senseless
I hope you {D}|I hope {P} will {D}|may {P} {D}|I want to see {P} {D}|nobody would miss {Y}, {S}|the world is better off without {Y}|{S}|{S}, you {J}|why don't you {D}|you should {D}|{P} should {D}|you should never have been born|do us a favour and {D}
{G} are {H}|{G} are {A} {H}|{G} are {L}|{G} are {A}|{G} are {A}, all of them|all {G} are {H}|all {G} are {L}|{G} should {X}|{G} ought to {X}|{G} must {X}|{G} are {H} and should {X}|get rid of {G}|they must {X} because {G} are {A}|{G} are {A}, they should {X}|blame {G}, they should {X}|shut {G} out|we must get rid of {G}|get {G} out of here|I hate {G}|we don't want {G} here|no {G} here, they are {H}|never hire {G}, they are {L}|never trust {G}|it's all {G}, they must {X}|{G} ruin the country|{G} steal everything|{G} don't belong here, they are {L}|only {G} are so dumb|{G} are too stupid to lead|dirty {G}|fucking {G}|bloody {G}|kill all {G}|death to {G}|we should {V} all {G}|{G} are {H}, {C}|{G} are unfit for anything, they are {L}
I want to {F} you|I want to {F} you {K}|let me {F} you|come and {F} me|will you {F} me {K}|shall I {F} you {W}|I'm so horny|I am horny for you|show me your {B}|show me your {B} {W}|show us your {B}|send a picture of your {B}|send nudes|send me something naked|I dream of your {B}|your {B} makes me hard|I jerk off to you {K}|he {R} her {K}|she {R} him {K}|she {R} him until he came|he {R} her from behind|he took her {K}|they {R} each other {K}|she took off her {B} and {R} him|wet and hard {K}|hot porn|free porn and {B}|xxx clips|hard sex {K}|enjoy the {B}|I sit naked {K}|you naked {K} {W}|my hands on your {B}|moaning with orgasm|they both came {K}|blow me {W} and get a raise|a quick fuck {K}|a blowjob {K}|she is wet in her {B}|spread your legs {K}""",
    "sv": "{P} är en {J}|{P} är {A}|din {J}|din {A} {J}|du är {A}|du är en {J}|vilken {J}|{C}|{C}, din {J}|jag ska {V} {Y}|jag ska {V} {Y} {W}|någon borde {V} {P}|hoppas du får {D}|{S}|{S}, din {J}|{G} är {H}|{G} är {L}|{G} ska {X}|jag hatar {G}|jag vill {F} dig|visa mig {B}|han {R} henne {K}",
    "da": "{P} er en {J}|{P} er {A}|din {J}|din {A} {J}|du er {A}|du er en {A} {J}|sikke en {J}|{C}|{C}, din {J}|jeg vil {V} {Y}|jeg skal {V} {Y} {W}|nogen burde {V} {P}|gid du må {D}|{S}|{S}, din {J}|{G} er {H}|{G} er {L}|{G} skal {X}|{G} er {H} og skal {X}|jeg hader {G}|jeg vil {F} dig|vis mig {B}|han {R} hende {K}",
    "de": "{P} ist ein {J}|{P} ist {A}|du {J}|du {A}es {J}|du bist {A}|du bist ein {J}|was für ein {J}|{C}|{C}, du {J}|ich werde {Y} {V}|ich werde {Y} {W} {V}|man sollte {P} {V}|du sollst {D}|{S}|{S}, du {J}|{G} sind {H}|{G} sind {L}|{G} müssen {X}|{G} sind {H} und müssen {X}|ich hasse {G}|ich will dich {F}|zeig mir {B}|er {R} sie {K}",
    "fr": "{P} est un {J}|{P} est {A}|espèce de {J}|sale {J}|tu es {A}|tu es un {J}|quel {J}|{C}|{C}, {J}|je vais te {V}|je vais {V} {P} {W}|il faut {V} {P}|j'espère que tu vas {D}|{S}|{S}, {J}|{G} sont {H}|{G} sont {L}|{G} {X}|qu'on les {V} tous, {G}|je hais {G}|je veux te {F}|montre {B}|il la {R} {K}",
    "es": "{P} es un {J}|{P} es {A}|eres un {J}|eres {A}|maldito {J}|qué {J}|{C}|{C}, {J}|te voy a {V}|voy a {V} a {P} {W}|alguien debe {V} a {P}|ojalá te toque {D}|{S}|{S}, {J}|{G} son {H}|{G} son {L}|{G} deben {X}|{G} son {H}, deben {X}|hay que echar a {G}, son {H}|odio a {G}|quiero {F} contigo|enséñame {B}|él la {R} {K}",
}

#: Frames of harmless sentences, many of which share words with the ones above.
GOOD = {
    "nb": """{n} og {n} {T}|{n} er {v} {T}|{n} ble {v} {T}|{n} og {n} ble {v} {T}|{n} er {a} {T}|{n} {T} og {n} {T}|{n} {v} {n}|{P} {v} {n}|{N} {v} {n} {T}|{G} {v} {n} {T}|jeg {v} {n}|du {v} {n}|vi må {i} {n}|{P} skal {i} {n} {W}|jeg vil {i} {n}|du bør {i} {n}|{G} bør {i} {n}|kan du {i} {n}|{n} er {a}|{n} var {a} og {a}|{P} er {a}|{a} {n}|{n}|{n} og {n}|{n} til {P}|{n} til {G}|{n} {T}|{n} for {n}|{n} {K}|ikke {i} {n}|{n} er {v}|en {a} {n} {K}|så {a} var {n}|for en {a} {n}|{n} i {n}|{i} {n}, {i} {n}|{P} var {a} da {N} {v} {n}|håper {n} er {a} {W}|{N} skal {i} {n} og {i} {n}|alle {G} kan {i} {n}|{n}, {n} og {n}
{N} {U}|{N} {U} {T}|{T} sa {N} ifra, og {N} {U}|{N} {U}, og {N} {U}|{N} {U} {T}, men {N} {U} {T}|{P} {U}|{P} {U} {T}|{P} er {Q}|{P} er {Q} og {Q}|du er {Q}|dere er {Q}|takk til {P}|takk, {P}, du er {Q}|hilsen {P}|hilsen til {P}: du er {Q}|til {P}: {N} {U}|hei, {P} {U} {T}|kan {P} ringe meg {W}|skal vi spise lunsj {W}|vi sees {W}|kjære {P}|jeg håper {P} er {Q} {W}|jeg savner {P}|ta kontakt med {P} {W}|send bilag til {P}|send meg tallene {W}|vis meg tallene {W}|jeg vil betale {P} {W}|jeg vet hvor {N} bor|{P} døde {T}|{P} mistet jobben {T}|jeg er dum som glemte det|regningen er feil
{O} handler om {M}|{O} handler om {M} mot {G}|{O} om {M} mot {G} ble lagt fram {T}|{O} tar opp {M}|{O} sier at {M} mot {G} er straffbart|{O} etterforsker {M} mot {P}|{O} fordømmer {M}|{O} gjelder {M} {T}|vi tar avstand fra {M} mot {G}|{P} er siktet for {M}|dømt for {M} {T}|varsel om {M} er behandlet|nulltoleranse for {M}|ingen form for {M} godtas|{M} mot {G} skal meldes|rutine mot {M}|{P} forteller om {M} i oppveksten|{P} ble utsatt for {M}|{O} beskriver hvordan {P} opplevde {M}
{G} har like rettigheter|{G} har rett til hjelp|{G} er velkomne|{G} er {Q}|{G} får tilbud om kurs|{G} {U}|{N} støtter {G}|{N} ansetter {G}|{N} vil ansette flere {G}|tilbud til {G}|norskkurs for {G}|andelen {G} i styret økte|{G} og {G} er med i avtalen|likestilling for {G}|vi takker alle {G} som hjalp|{O} om {G} i arbeidslivet|{G} fikk fri {T}|møte med {G} {W}|{G} vant saken {T}
{N} {Z} {E}|{N} {Z} {E} {T}|{E} ble {Q}|{N} {Z} {E}, og {N} {U}|{E} er til salgs|{N} må {z} {E}|{N} vil {z} {E} {T}|{N} ba {N} {z} {E}|{N} ble bedt om å {z} {E} {K}|{P} skal {z} {E} {W}|de skal {z} {E}|jeg skal {z} {E} {W}|noen må {z} {E}|{N} skal kjøpe {E}|{E} døde {T}|{E} er forsikret|det brant {K} {T}|gift mot {E}|{N} kjempet mot {E}
{O} om {I}|{N} tilbyr {I}|{I} er gratis {T}|kurs i {I} {W}|{N} fikk støtte til {I}|{N} viser {I}|lege i {I}|{O} handler om {I}|butikken selger {I}
ja|nei|ok|hei|mvh|god dag|takk|se vedlegg|note|sum|i alt|egenkapital|varelager|lønn og pensjon|drift|aksjer|resultat|utbytte|vedlegg|vennlig hilsen {P}|god jul|god bedring|til orientering|merknad|{N}|{P}|{E}|{I}|hallo|heisann|hei igjen|god morgen|god kveld|kjære alle|beste hilsen|hilsen oss|ha en fin dag|god helg|takk for i dag|til alle|ps|vedlagt|se under|hm|ha ha|javel|bra|fint""",
    "nn": """{n} og {n} {T}|{n} er {v} {T}|{n} vart {v} {T}|{n} og {n} vart {v} {T}|{n} {v} {n}|{P} {v} {n}|{N} {v} {n} {T}|{G} {v} {n} {T}|eg {v} {n}|du {v} {n}|vi må {i} {n}|{P} skal {i} {n} {W}|eg vil {i} {n}|{G} bør {i} {n}|kan du {i} {n}|{n} er {a}|{n} var {a} og {a}|{P} er {a}|{a} {n}|{n}|{n} og {n}|{n} til {P}|{n} til {G}|{n} {T}|{n} {K}|ikkje {i} {n}|for ein {a} {n}|håpar {n} er {a} {W}|{N} skal {i} {n}|alle {G} kan {i} {n}
{N} {U}|{N} {U} {T}|{N} {U}, og {N} {U}|{P} {U}|{P} {U} {T}|{P} er {Q}|{P} er {Q} og {Q}|du er {Q}|de er {Q}|takk til {P}|helsing {P}|helsing til {P}: du er {Q}|hei, {P} {U} {T}|kan {P} ringje meg {W}|vi sest {W}|kjære {P}|send meg tala {W}|vis meg tala {W}|eg vil betale {P} {W}|{P} døydde {T}|rekninga er feil|eg er lei for det
{O} handlar om {M}|{O} handlar om {M} mot {G}|{O} tek opp {M}|{O} granskar {M} mot {P}|vi tek avstand frå {M} mot {G}|{P} er sikta for {M}|dømd for {M} {T}|nulltoleranse for {M}|{M} mot {G} skal meldast|rutine mot {M}|{P} vart utsett for {M}
{G} har like rettar|{G} er velkomne|{G} er {Q}|{G} får tilbod om kurs|{G} {U}|{N} støttar {G}|{N} treng fleire {G}|tilbod til {G}|likestilling for {G}|{G} fekk fri {T}
{N} {Z} {E}|{N} {Z} {E} {T}|{E} er til sals|{N} må {z} {E}|{N} vil {z} {E} {T}|{N} bad {N} {z} {E}|{P} skal {z} {E} {W}|eg skal {z} {E} {W}|nokon må {z} {E}|{N} skal kjøpe {E}|{E} døydde {T}|gift mot {E}
{O} om {I}|{N} tilbyr {I}|{I} er gratis {T}|kurs i {I} {W}|{N} syner {I}|{O} handlar om {I}
ja|nei|ok|hei|mvh|takk|sjå vedlegg|note|sum|eigenkapital|varelager|løn og pensjon|drift|aksjar|resultat|{N}|{P}|{E}|{I}|hallo|heisann|god morgon|god kveld|kjære alle|beste helsing|ha ein fin dag|god helg|til alle|vedlagt|sjå under|bra|fint""",
    "en": """{n} and {n} {T}|{n} are {v} {T}|{n} were {v} {T}|{n} and {n} were {v} {T}|{n} is {a} {T}|{n} {T} and {n} {T}|{n} {v} {n}|{P} {v} {n}|{N} {v} {n} {T}|{G} {v} {n} {T}|I {v} {n}|you {v} {n}|we must {i} {n}|{P} will {i} {n} {W}|I want to {i} {n}|you should {i} {n}|{G} should {i} {n}|can you {i} {n}|{n} is {a}|{n} was {a} and {a}|{P} is {a}|{a} {n}|{n}|{n} and {n}|{n} for {P}|{n} for {G}|{n} {T}|{n} of {n}|{n} {K}|do not {i} {n}|{n} was {v}|a {a} {n} {K}|so {a} was {n}|what a {a} {n}|{n} in {n}|{P} was {a} when {N} {v} {n}|I hope {n} is {a} {W}|{N} will {i} {n} and {i} {n}|all {G} can {i} {n}|{n}, {n} and {n}
{N} {U}|{N} {U} {T}|{N} {U}, and {N} {U}|{N} {U} {T}, but {N} {U} {T}|{P} {U}|{P} {U} {T}|{P} is {Q}|{P} is {Q} and {Q}|you are {Q}|they are {Q}|thanks to {P}|thank you, {P}, you are {Q}|regards, {P}|note to {P}: you are {Q}|to {P}: {N} {U}|hello, {P} {U} {T}|can {P} call me {W}|shall we have lunch {W}|see you {W}|dear {P}|I hope {P} is {Q} {W}|I miss {P}|get in touch with {P} {W}|send vouchers to {P}|send me the figures {W}|show me the figures {W}|I want to pay {P} {W}|I know where {N} lives|{P} died {T}|{P} lost the job {T}|I feel stupid, sorry|the invoice is wrong
{O} deals with {M}|{O} deals with {M} against {G}|{O} on {M} against {G} was presented {T}|{O} takes up {M}|{O} says {M} against {G} is a crime|{O} investigates {M} against {P}|{O} condemns {M}|{O} concerns {M} {T}|we reject {M} against {G}|{P} is charged with {M}|convicted of {M} {T}|zero tolerance for {M}|no form of {M} is accepted|{M} against {G} must be reported|rules against {M}|{P} spoke of {M} in childhood|{P} suffered {M}|{O} tells how {P} suffered {M}
{G} have equal rights|{G} are welcome|{G} are {Q}|{G} are offered courses|{G} {U}|{N} supports {G}|{N} employs {G}|{N} wants to hire more {G}|an offer to {G}|classes for {G}|the share of {G} on the board rose|{G} and {G} are covered|equal pay for {G}|we thank all {G} who helped|{O} on {G} at work|{G} may take leave {T}|a meeting with {G} {W}|{G} won the case {T}
{N} {Z} {E}|{N} {Z} {E} {T}|{N} {Z} {E}, and {N} {U}|{E} are for sale|{N} must {z} {E}|{N} will {z} {E} {T}|{N} asked {N} to {z} {E}|{N} was told to {z} {E} {K}|{P} will {z} {E} {W}|I will {z} {E} {W}|somebody must {z} {E}|{N} will buy {E}|{E} died {T}|{E} insured for 1000|a fire broke out {K} {T}|poison against {E}|{N} fought {E}
{O} on {I}|{N} offers {I}|{I} is free {T}|a course in {I} {W}|{N} got support for {I}|{N} shows {I}|{O} is about {I}|the shop sells {I}
yes|no|ok|hello|regards|good day|thanks|see attachment|note|total|equity|inventory|wages and pensions|operations|shares|result|dividend|best, {P}|get well soon|for information|x|xx|abc|x y z|test|{N}|{P}|{E}|{I}|hi|hi all|hey there|good morning|good evening|dear all|dear sir|cheers|yours|sincerely|have a nice day|to all|ps|enclosed|see below|hm|ha ha|well|fine|great|sure""",
    "sv": "{N} {U}|{N} {U} {T}|{P} är {Q}|{P} {U} {T}|{O} handlar om {M}|{O} utreder {M} mot {P}|{M} mot {G} ska anmälas|{G} är välkomna|{N} anställer {G}|{N} {Z} {E} {T}|{O} om {I}|tack",
    "da": "{N} {U}|{N} {U} {T}|{P} er {Q}|{P} {U} {T}|{O} handler om {M}|{O} efterforsker {M} mod {P}|{M} mod {G} skal anmeldes|{G} er velkomne|{N} ansætter {G}|{N} {Z} {E} {T}|{O} om {I}|tak",
    "de": "{N} {U}|{N} {U} {T}|{P} ist {Q}|{P} {U} {T}|{O} handelt von {M}|{O} ermittelt wegen {M}|{M} gegen {G} wird angezeigt|{G} sind willkommen|{N} beschäftigt {G}|{N} {Z} {E} {T}|{O} über {I}|danke",
    "fr": "{N} {U}|{N} {U} {T}|{P} est {Q}|{P} {U} {T}|{O} traite de {M}|{O} enquête sur {M}|{G} sont bienvenus|{N} embauche {G}|{N} {Z} {E} {T}|{O} sur {I}|merci",
    "es": "{N} {U}|{N} {U} {T}|{P} es {Q}|{P} {U} {T}|{O} trata de {M}|{O} investiga {M}|{G} son bienvenidos|{N} contrata a {G}|{N} {Z} {E} {T}|{O} sobre {I}|gracias",
}

#: Closed-class words. They say nothing about either side and are put anywhere in sentences of both.
SMALL_WORDS = {
    "nb": "jeg du han hun vi dere de det den meg deg ham henne oss dem seg min din sin hans hennes vår deres dette disse denne noen noe ingen alle alt mange få hver begge selv en et to tre fire fem seks sju åtte ni ti tolv tjue hundre og eller men for at om hvis når da mens før etter siden fordi så som enn i på av til fra med uten mellom mot over under ved hos gjennom rundt langs bak foran inn ut opp ned hjem bort her der nå da snart alltid aldri ofte kanskje bare også ikke jo vel nok svært veldig ganske litt mer mest mindre igjen allerede fortsatt ennå hvor hva hvem hvilken hvorfor hvordan er var blir ble blitt har hadde kan kunne vil ville skal skulle må måtte bør burde får fikk gjør gjorde gjort går gikk gå kommer kom komme tar tok ta ser så se sier sa si vet visste tror trodde å",
    "nn": "eg du han ho vi me de dei det den meg deg oss dykk seg min din sin hans hennar vår deira dette desse denne nokon noko ingen alle alt mange få kvar begge sjølv ein eit ei to tre fire fem seks sju åtte ni ti tolv tjue hundre og eller men for at om viss når då medan før etter sidan fordi så som enn i på av til frå med utan mellom mot over under ved hos gjennom rundt langs bak framfor inn ut opp ned heim bort her der no snart alltid aldri ofte kanskje berre også ikkje jo vel nok svært veldig ganske litt meir mest mindre igjen alt framleis enno kvar kva kven kvifor korleis er var vert vart har hadde kan kunne vil ville skal skulle må måtte bør burde får fekk gjer gjorde gjort går gjekk gå kjem kom kome tek tok ta ser såg sjå seier sa veit visste trur trudde å",
    "en": "i you he she we they it don t ll ve m re s d isn aren won doesn didn can couldn me him her us them my your his its our their this that these those some any no none all many few each both self one two three four five six seven eight nine ten twelve twenty hundred and or but for that if when while before after since because so as than in on of to from with without between against over under at by through around along behind into out up down home away here there now then soon always never often perhaps only also not well enough very quite rather a an the more most less again already still yet where what who which why how is was be been being are were has had have can could will would shall should must may might do does did done go goes went come came take took see saw say said know knew think thought like",
}

#: How often a language is drawn, and what is put around a sentence (quotes, salutations, endings).
SHARES = {"nb": 40, "nn": 16, "en": 28, "sv": 3, "da": 3, "de": 4, "fr": 3, "es": 3}
AROUND = ("{}", "{}", "{}", "{}", "{}!", "{}?", "«{}»", '"{}"', "- {}", "{} ...", "> {}", "({})", "ps: {}")


def _fill(pattern: str, words: dict[str, list[str]], rng: random.Random) -> str:
    while "{" in pattern:
        at = pattern.index("{")
        pattern = pattern[:at] + rng.choice(words[pattern[at + 1]]) + pattern[at + 3 :]
    return pattern


def _split(text: str) -> list[str]:
    return [x for line in text.split("\n") for x in line.split("|")]


def _loosened(text: str, small: list[str], rng: random.Random) -> str:
    """A sentence with up to three closed-class words put in anywhere."""
    words = text.split(" ")
    for _ in range(rng.randint(1, 3)):
        words.insert(rng.randrange(len(words) + 1), rng.choice(small))
    return " ".join(words)


def _strange(rng: random.Random) -> str:
    """Words that nobody knows, as names and noise are."""
    letters = ("bcdfghjklmnprstvwz", "aeiouyæøåéàöü")
    return " ".join("".join(rng.choice(letters[(i + k) % 2]) for i in range(rng.randint(1, 9))) for k in (rng.randrange(2) for _ in range(rng.randint(1, 4))))


def frames() -> list[tuple[str, str, int]]:
    """Every frame: language, pattern, 1 for abusive."""
    return [(lang, x, y) for y, side in ((1, BAD), (0, GOOD)) for lang, t in side.items() for x in _split(t)]


def examples(n: int, seed: int = 3) -> list[tuple[str, str, int]]:
    """``n`` sentences (language, text, 1 for abusive) filled from the frames, three in five of them harmless."""
    rng = random.Random(seed)
    words = {lang: {k: v.split("|") for k, v in w.items()} for lang, w in WORDS.items()}
    # a line of frames is a kind of sentence; kinds are drawn alike, so a kind with few frames counts as much
    bad, good = ({lang: [line.split("|") for line in t.split("\n")] for lang, t in side.items()} for side in (BAD, GOOD))
    langs, shares = list(SHARES), list(SHARES.values())
    small = {lang: t.split() for lang, t in SMALL_WORDS.items()}
    out = []
    for i in range(n):
        lang = rng.choices(langs, shares)[0]
        y = int(i % 5 > 2)
        frame = rng.choice(rng.choice((good, bad)[y][lang]))
        text = _fill(frame, words[lang], rng)
        if lang in small and rng.random() < 0.5:
            text = _loosened(text, small[lang], rng)
        if not y and rng.random() < 0.08:  # alone, or before a sentence
            out.append((lang, _strange(rng) + rng.choice(("", " " + text)), 0))
        else:
            out.append((lang, rng.choice(AROUND).format(text), y))
    return out
