"""Sentences for measuring the classifier of abusive language.

None of them is used for training. ``ABUSIVE`` and ``HARMLESS``, mostly near misses, were written before
the frames it is trained on and looked at while the kinds of frames were chosen; ``LATER_ABUSIVE`` and
``LATER_HARMLESS`` were written after the frames were final, so only they measure without bias. A
sentence a line, after its language.
"""

ABUSIVE = """
nb Du er den mest ubrukelige lederen jeg har sett, din feige stymper.
nb Hvis du møter opp på kontoret igjen, banker jeg deg gul og blå.
nb Håper toget kjører over deg i morgen.
nb Folk fra det landet er ikke annet enn dyr, og bør sperres inne.
nb Slike som deg burde vært druknet ved fødselen.
nb Hold den stygge kjeften din lukket, kjerring.
nb Vi burde kvitte oss med alle muslimene før de tar over bygda.
nb Hun er en billig hore som har ligget seg til stillingen.
nb Jeg fikk denne på epost: «din forbanna rotte, vi finner deg».
nb Kom hit og sug meg, så får du lønnsøkning.
nb Den fittetrynet av en sjef kan dra til helvete.
nb Jødene styrer bankene og burde fjernes fra jordens overflate.
nb Svartinger har ingenting å gjøre i et norsk styre.
nb En dag kutter jeg strupen på deg.
nb Jeg kommer hjem til deg i natt og tenner på.
nb Du er så dum at det gjør vondt å høre på deg, din evneveike sau.
nb Han dyttet henne ned på sofaen, dro ned buksa og trengte inn i henne.
nb Send et bilde av de store puppene dine, jeg er kåt.
nb Din mor er ei tøs.
nb Homser er syke i hodet og skulle vært låst inne.
nb Kvinner er for dumme til å lede et selskap.
nb Jeg pisser på deg og hele familien din.
nb Ingen kommer til å savne deg når du er død, så bare gjør det.
nb For noen inkompetente kretiner dere er i kommunen.
nb Dere skal få betale med blod.
nb Sigøynerne stjeler alt de ser, få dem vekk herfra.
nb R3visoren er en j4vla løgner.
nb d i n  k ø d d, ligg unna.
nb Sjefen vår er et r*vhøl uten like.
nb Gå og drukn deg.
nn Du er eit ynkeleg krek som ingen vil ha her.
nn Eg skal slå deg ned om du kjem hit ein gong til.
nn Utlendingane er skitne og bør sendast dit dei kom frå.
nn Hald munn, din feite gris.
nn Eg vonar du døyr snart.
nn Ho er ei hore, det veit heile bygda.
nn Vis meg kroppen din naken, så får du jobben.
nn Samane er late tjuvar alle saman.
nn Dra til helvete, alle i styret.
nn Nokon burde hengje rekneskapsføraren i næraste tre.
en You pathetic little worm, nobody wants you here.
en I'm going to cut your throat if you send another invoice.
en I hope your whole family burns.
en People from that country are animals and should be locked up.
en Shut your ugly mouth, you stupid cow.
en Someone ought to put a bullet in the landlord's head.
en She only got the job because she spreads her legs for the boss, the whore.
en Jews run the banks and should be wiped off the earth.
en Blacks are too lazy to work in this company.
en He pushed her onto the desk, pulled down her skirt and fucked her hard.
en Send me a picture of your tits, I'm so horny right now.
en Women are too stupid to read a balance sheet.
en Nobody would miss you if you died, so just do it.
en Gays are sick perverts and ought to be put away.
en Drop dead, you useless sack of crap.
en He wrote: "you filthy rat, we will find you and hurt you".
en You f*cking id1ot, learn to count.
en What an absolute wanker our treasurer is.
en We will come to your house tonight and set it on fire.
en Muslims are vermin and we should get rid of all of them.
en m o r o n, go back to school.
en I want to lick your wet pussy all night long.
en The caretaker is a disgusting pig who should rot in jail.
en Gypsies steal everything, kick them out.
en You are dumber than a rock and twice as ugly.
sv Din jävla idiot, håll käften.
sv Jag ska döda dig, ditt svin.
da Du er en klam lort, hold din kæft.
da Udlændinge er skadedyr og skal smides ud.
de Du bist ein dummes Arschloch, halt die Fresse.
de Ausländer sind Abschaum und müssen alle raus.
fr Va te faire foutre, espèce de connard.
fr Les immigrés sont de la vermine, qu'on les tue tous.
es Eres un hijo de puta y te voy a matar.
es Los inmigrantes son basura, hay que echarlos a todos.
"""

HARMLESS = """
nb Kjøpesummen er betalt i sin helhet.
nb Rettssaken mot den drapstiltalte starter mandag i tingretten.
nb Vi beklager forsinkelsen og sender ny faktura i dag.
nb Kan du ringe meg når du er tilbake fra lunsj?
nb Selskapet har ingen ansatte ved utgangen av året.
nb Skuddpremien på rev er hevet til 500 kroner.
nb Bonden slaktet tre griser og solgte kjøttet lokalt.
nb Jeg er dum som glemte vedlegget, her kommer det.
nb Politiet etterforsker trusler mot en ansatt ved skolen.
nb Hatefulle ytringer mot samer skal anmeldes, sier ombudet.
nb Museet viser nakenmalerier fra 1800-tallet.
nb Prevensjon er gratis for kvinner under 25 år.
nb Vi må kutte kostnadene og drepe noen av prosjektene.
nb Ugresset ble brent og rottene gift lagt ut for.
nb Kassereren døde i mai, og vi lyser fred over minnet.
nb Boken handler om jødenes skjebne under krigen.
nb Banken har tapt saken mot den tidligere direktøren.
nb Muslimske ansatte får fri ved id.
nb Kommunen tilbyr norskkurs for flyktninger og innvandrere.
nb Det er vondt å høre at du er syk, god bedring!
nb Hun er gravid og går ut i permisjon i oktober.
nb Hanen galer klokka fem, og naboen har klaget.
nb Kampen endte 4-0, vi ble fullstendig knust.
nb Gjelden skal slås sammen med lånet fra i fjor.
nb Denne regningen er feil, og jeg nekter å betale den.
nb Møtet var kjedelig, og kaffen var dårlig.
nb Jeg er svært misfornøyd med behandlingen og vurderer å gå til sak.
nb Brannvesenet rykket ut da garasjen tok fyr.
nb Legen undersøkte brystet hennes for kreft.
nb Varsleren opplyser at lederen skal ha kommet med seksuelle tilnærmelser.
nb Styret tar avstand fra rasisme og diskriminering.
nb Avfallet sorteres i fire fraksjoner.
nb Ny kontrakt om levering av svinekjøtt er signert.
nb Skipet ble hugget opp og vraket senket.
nb Pulsen min er høy, så jeg jobber hjemmefra.
nb Han satt i fengsel for drap i tolv år.
nn Kjøpesummen er betalt i rett tid.
nn Møtet er flytta til torsdag klokka ti.
nn Grisene og hønene er forsikra i same selskap.
nn Ho har slutta i stillinga si og flytta til Bergen.
nn Politiet granskar truslar mot læraren.
nn Me ønskjer flyktningane velkomne til bygda.
nn Rekneskapen er ferdig, og alle er nøgde.
nn Eg er lei for at svaret kom seint.
nn Tilskotet dekkjer halvparten av kostnaden.
nn Hesten vart avliva etter ulykka.
en The trial of the murder suspect begins on Monday.
en The purchase price has been paid in full.
en Please find the signed agreement attached.
en The police are investigating threats made against an employee.
en Jewish and Muslim staff may take religious holidays.
en Breast cancer screening is offered to women over fifty.
en The farmer slaughtered the pigs in November.
en We killed the old server and burned the backup to disc.
en Hate crimes against gay people must be reported, the ombudsman says.
en I feel stupid for forgetting the attachment, sorry.
en Our chairman died in March and will be missed.
en The painting of a nude woman was sold at auction.
en Shares were hammered and the fund got destroyed last week.
en Would you like to have lunch with me on Friday?
en The company employs refugees and immigrants in its plants.
en This invoice is wrong and I refuse to pay it.
en I am very disappointed with your service and want a refund.
en Dick Turner was appointed as company secretary.
en The cock crowed at five and woke the neighbours.
en He shot the photographs for the annual report.
en The bastard file is used for sharpening saws.
en She gave birth to twins and is on leave.
en Rat poison was placed in the basement by the contractor.
en The book tells the story of slavery and of black workers.
en We must beat our competitors on price.
en The union demands equal pay for women and men.
en The witness described how she had been harassed at work.
en Dumb terminals were replaced with laptops.
en The old barn burned down last winter and was rebuilt.
en He was sentenced to ten years for rape.
en The bloody battle of 1066 is shown in the tapestry.
en Hot water and heating are included in the rent.
sv Vi tackar för er beställning och återkommer på måndag.
sv Polisen utreder hot mot en lärare.
da Regningen er betalt, og sagen er afsluttet.
de Die Rechnung wurde vollständig bezahlt.
de Die Polizei ermittelt wegen Drohungen gegen einen Lehrer.
fr La facture a été payée en totalité.
fr Le musée expose des tableaux du dix-huitième siècle.
es La empresa contrata a refugiados e inmigrantes.
es El precio de compra ha sido pagado.
"""

LATER_ABUSIVE = """
nb Din elendige lusing, få deg en hjerne.
nb Neste gang jeg ser revisoren, knekker jeg nakken på ham.
nb Alle tiggerne er parasitter som bør sendes hjem.
nb Vil du bli med på rommet mitt så jeg kan slikke deg?
nb Den kua på lønnskontoret er så stygg at jeg spyr.
nb Jeg ønsker at du får kreft og dør alene.
nb Regnskapsføreren er en jævla tyv og en løgner.
nb Du burde ta livet av deg, ingen liker deg.
nb Tatere og sånt pakk vil vi ikke ha som naboer.
nb Hold kjeft, din gamle gris.
nb Kvinnfolk hører hjemme på kjøkkenet, de er for dumme til styrearbeid.
nb Han rev av henne trusene og pulte henne på kjøkkenbordet.
nb Dere er en gjeng udugelige slabbedasker og forbanna idioter.
nb Vi skal brenne ned hytta di med deg inni.
nn Din late tjuv, reis til pokkers.
nn Eg slår deg i hel om du ringjer meg att.
nn Muslimane er skadedyr og må ut av landet.
nn Du er den styggaste hurpa i bygda.
en You lying sack of garbage, crawl back into your hole.
en If I see the accountant again I will break his jaw.
en All those beggars are parasites, send them back.
en Come to my room so I can lick you all over.
en That fat cow in payroll makes me want to puke.
en I wish you cancer and a lonely death.
en Our bookkeeper is a fucking thief and a liar.
en You ought to kill yourself, nobody likes you.
en Girls belong in the kitchen, they are too stupid for a board.
en He tore off her panties and fucked her on the kitchen table.
en We will burn down your cabin with you in it.
en Africans have smaller brains and should not be allowed to vote.
en Shut up, old pig.
en What a bunch of useless clowns and bloody idiots you are.
"""

LATER_HARMLESS = """
nb Årsmøtet vedtok å øke kontingenten med femti kroner.
nb Vedlagt følger referatet fra forrige styremøte.
nb Kan noen hente nøklene hos vaktmesteren før fredag?
nb Inntektene falt som følge av lavere strømpriser.
nb Det ble ikke avdekket vesentlige feil i regnskapet.
nb Heisen er ute av drift til over helgen.
nb Takk for en hyggelig kveld, maten var nydelig.
nb Vi har mottatt klagen din og svarer innen tre uker.
nb Lånet er sikret med pant i eiendommen.
nb Barna leker i gata, så kjør forsiktig.
nb Utvalget foreslår strengere straff for vold i nære relasjoner.
nb Sykepleieren målte blodtrykket og ga ham en sprøyte.
nb Fiskerne fanget mer torsk enn ventet.
nb Beboerne i tredje etasje ber om nye vinduer.
nb Selskapet har søkt om utsettelse med å levere skattemeldingen.
nb Hunden bet postmannen, men skaden var liten.
nb Revisor har ingen merknader til årsberetningen.
nb Billettene selges ved inngangen.
nb Foreldrene er invitert til møte om mobbing på skolen.
nb Elevene lærte om seksualitet og grensesetting.
nn Straumprisen auka mykje i haust.
nn Styret har hatt seks møte i løpet av året.
nn Vegen er stengd på grunn av ras.
nn Vi treng fleire frivillige til dugnaden.
nn Guten fall av sykkelen og braut armen.
en The annual meeting decided to raise the fee by five pounds.
en Could somebody fetch the keys from the caretaker by Friday?
en Revenue fell because of lower power prices.
en No material errors were found in the accounts.
en The lift is out of order until after the weekend.
en Thank you for a lovely evening, the food was delicious.
en We have received your complaint and will answer within three weeks.
en The loan is secured by a mortgage on the property.
en Children play in the street, so please drive carefully.
en The committee proposes harsher penalties for domestic violence.
en The nurse took his blood pressure and gave him an injection.
en Fishermen caught more cod than expected.
en The dog bit the postman, but the wound was small.
en Parents are invited to a meeting about bullying at school.
en The army defended the city against the invaders.
en Her new novel is about a prostitute in Victorian London.
en Tickets are sold at the entrance.
"""


def sentences(block: str) -> list[tuple[str, str]]:
    return [tuple(line.split(" ", 1)) for line in block.strip().split("\n")]
