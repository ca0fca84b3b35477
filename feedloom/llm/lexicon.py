"""General vocabulary of abuse, hate and explicit sex, in classes of meaning.

The entries are words of general dictionaries and of public lists of offensive words, not passages of any corpus; what a class is
worth is learned by the model from labelled rows, starting from the prior weights given here. An entry that ends in ``*`` stands
for all words that begin so; one of several words for these words in a row. All are written folded: lower case, without marks.
"""

from __future__ import annotations

# The vocabulary, by class.
CLASSES: dict[str, str] = {
    # who speaks, who is spoken to, who is spoken of
    "FIRST": "i, we, my, our, me, us, yo, nosotros, je, j, nous, mon, ich, wir, mein, eu, nos, meu, io, noi, ik, я, мы",
    "YOU": "you, your, yours, yourself, yourselves, u, ur, youre, ya, te, ti, tu, tus, usted, ustedes, vosotros, vos, eres, toi, ton, ta, tes, vous, votre, du, dich, dir, dein, deine, deiner, euch, euer, voce, voces, seu, sua, teu, tua, lei, sei, jij, jou, jouw, ты, тебя, тебе, твой, вы, вас, вам",
    "HIM": "he, him, his, she, her, hers, whoever, someone, somebody, ella, lui, elle, il, er, sie, ihn, ihm, ele, ela, он, она, его, ее",
    "THAT": "that, this, those, these, what a, such a, el, la, ese, esse, essa, ce, cet, cette, diese*, esta, este, este, espece, этот",
    "NAMED": "driver, drivers, conductor, staff, clerk, manager, inspector, moderator, mods, admin, dispatcher, neighbour, neighbor, guy, man, woman, girl, boy, author, poster, planner, conductora, conductor, chofer, fahrer, schaffner, chauffeur, conducteur, motorista, cobrador, водитель",
    "MODAL": "should, shall, must, ought, deserve, deserves, deserved, gonna, will, wanna, deberia, deberian, deben, merece, merecen, hay que, devrait, devraient, doivent, faut, sollte, sollten, mussen, gehort, gehoren, verdient, deveria, deveriam, devem, должны, надо",
    "WISH": "hope, hopes, hoping, wish, wishes, ojala, espero, j espere, hoffe, hoffentlich, tomara, надеюсь, чтоб",
    # insults
    "INSULT": """idiot*, moron*, imbecil*, cretin*, scumbag*, bastard*, jackass*, halfwit*, nitwit*, dimwit*, numbskull*, blockhead*, bonehead*, knucklehead*, simpleton*, dumbass*, dipshit*, shithead*, dickhead*, asshole*, arsehole*, ass hat,
 douche*, tosser*, wanker*, twat*, cunt*, prick, pricks, bitch*, slut*, whore*, skank*, bellend*, bollock*, retard*, spastic*, loser, losers, coward*, creep, creeps, weirdo*, lowlife*, degenerate*, sleazeball*, slimeball*, swine, weasel, weasels,
 motherfucker*, fucker*, fuckface*, fuckwit*, cocksucker*, jerkoff*, pillock*, muppet, buffoon*, dolt*, dunce*, nincompoop*, ignoramus*, crybaby, snowflake, leech, sucker, suckers, jerk, jerks, fool, fools, dumbo, dullard, airhead*, scum, lardass, fatso, hag, crone, oaf, lout, thug, brat, psycho, lunatic,
 idiota*, imbecil*, estupid*, cabron*, gilipollas, pendej*, payaso*, tarado*, mamon*, hijo de puta, hija de puta, hijos de puta, puta, puto, capullo*, subnormal*, maricon*, zorra, gusano, inutil, inutiles, cerdo, cerda, basura humana, mierda,
 connard*, connasse*, abruti*, salaud*, salope*, ordure, batard*, encule*, debile*, cretin*, bouffon*, pauvre con, sale con, gros con, minable*, crevard*, fils de pute, tocard*, pute,
 vollidiot*, idiot*, trottel*, depp, deppen, arschloch*, schwachkopf*, dummkopf*, wichser*, mistkerl*, drecksau*, drecks*, schlampe*, hurensohn*, missgeburt*, penner, spinner, volltrottel*, scheisskerl*, schwein, schweine, versager*, blodmann, lappen, spast*, miststuck*,
 otario*, canalha*, palhac*, burro, burra, babaca*, arrombad*, filho da puta, filha da puta, cuzao, desgracad*, vagabund*, idiota*, imbecil*, trouxa*, merda, lixo humano, corno,
 stronzo*, coglione*, deficiente, bastardo, cazzo, klootzak*, eikel, lul, sukkel, debil*, kretyn*,
 идиот*, дебил*, дурак*, дура, тварь, твари, ублюд*, мразь, мрази, козел, козл*, сволоч*, придур*, кретин*, тупица, тупой, урод, уроды, скотина, сука, гнида, падла, 馬鹿, バカ, ばか野郎, クズ, 間抜け, アホ, غبي, احمق, أحمق, حمار, كلب""",
    "WEAK": "pig, pigs, rat, rats, dog, dogs, cow, cows, donkey, worm, worms, snake, clown, clowns, joke, trash, garbage, rubbish, filth, crap, dirt, pest, monkey, animal, animals, toad, slug, maggot, maggots, liar, liars, thief, thieves, crook*, parasite, parasites, nobody, failure, disgrace, embarrassment, burro, perro, rata, ratas, basura, chien, porc, ratte, sau, hund, affe, porco, rato, lixo, cane, maiale",
    "DEROG": """stupid*, dumb*, disgusting, pathetic, worthless, useless, brainless, spineless, gutless, miserable, lazy, filthy, incompetent, ugly, rotten, vile, despicable, idiotic, moronic, imbecilic, braindead, brain dead, lying, damn, damned, fucking, fuckin, effing, bloody, sodding, goddamn*, freaking,
 fat, smelly, stinking, greasy, slimy, sleazy, sick, twisted, ignorant, clueless, hopeless, sorry excuse, inutil*, estupid*, asquero*, maldit*, pinche, puto, stupide*, minable*, nulle, dreckig*, verdammt*, dumm*, blod*, damlich*, hasslich*, unfahig*, faul*, verfickt*, maldit*, nojent*, estupid*, burro, feio, feia, miseravel, preguicos*,
 тупой, тупая, тупые, жалк*, поган*, вонюч*, проклят*""",
    "CURSE": "fuck, fucked, fucks, shit, shitty, bullshit, piss, pissed, arse, ass, joder, mierda, carajo, merde, putain, bordel, scheisse, scheiss*, kacke, porra, caralho, merda, блядь, бля, хуй, хуйня, пизд*, нахуй",
    "DISMISS": """go to hell, rot in hell, burn in hell, get lost, shut up, shut your, shut it, drop dead, get stuffed, piss off, sod off, bugger off, fuck off, fuck you, screw you, go fuck, eat shit, eat dirt, suck it, crawl back, crawl under, jump off, jump in front, do the world a favour, do the world a favor, do us a favour, do everyone a favour, kill yourself, hang yourself, drown yourself, kys, go die, go hang, go drown, go jump, choke on, bite me, up yours, kiss my ass, waste of space, waste of oxygen, waste of air, waste of skin, waste of breath,
 piece of shit, piece of crap, piece of garbage, piece of trash, piece of filth, piece of dirt, son of a bitch, sons of bitches, nobody likes you, nobody loves you, nobody wants you, no one likes you, nobody would miss you, your mother, ya mama, sorry excuse for, excuse for a human, shame on you, bunch of, pack of, brain of a, iq of, too stupid, too dumb, how dumb, how stupid, dumber than, thicker than, uglier than, go back to school, you make me sick, hate your guts,
 vete a la mierda, vete al infierno, callate*, cierra la boca, muerete*, que te den, chinga tu, chupame, ojala te mueras, cala a boca, cala boca, vai te foder, vai se foder, vai a merda, vai para o inferno, va te faire, va te faire foutre, ferme la, ta gueule, ferme ta gueule, va crever, creve, nique ta, casse toi, halt die klappe, halt die fresse, halts maul, halt dein maul, fahr zur holle, verpiss dich, leck mich, fick dich, geh sterben, vaffanculo, stai zitto, rot op, houd je bek,
 заткнись, пошел ты, иди к черту, иди нахуй, сдохни, убей себя, 死ね, 黙れ, 消えろ, くたばれ, اخرس, اذهب الى الجحيم""",
    # threats
    "HURT": """you die, will die, must die, should die, hope you die, they die, rot in, you rot, he rots, she rots, they rot, you suffer, make you suffer, hit you, hit him, hit her, hit them, skin you, gut you, stone you, regret it, regret this, regret that, in the face, kill, kills, killed, murder*, strangle*, stab, stabbed, shoot, shot, punch*, slap, slapped, smack*, kick, kicked, beat, beaten, beating, smash*, crush*, break, burn, burned, burnt, hang, hanged, drown, choke*, bleed, bury, hurt, knock, cripple*, slit, gouge, rip, run over, run down, run you over, torch, bash, maul, behead*, rape, lynch*, gassed, rots, suffers, pay for this, crash, whip,
 matar, matare, mataria, mato, muere, mueras, romper, rompo, partir, pegar, golpear, quemar, atropellar, atropelle*, apunalar, ahogar, tuer, crever, casser, casse, frapper, cogner, bruler, brule, ecraser, ecrase, pendre, egorger, umbringen, bring dich um, schlag*, tote*, toten, verprugel*, abstechen, abknallen, brech*, verbrenn*, uberfahr*, erwurg*, matar, matarei, quebrar, quebro, bater, surra, esfaquear, atropelar, enforcar, arrebentar,
 убью, убить, убей, зарежу, сломаю, побью, избить, застрелю, сожгу, 殺す, 殺し, 殴る, 刺す, سأقتلك, اقتلك""",
    "BODY": "jaw, neck, teeth, legs, leg, nose, face, arms, bones, skull, throat, ribs, kneecaps, knees, spine, guts, eyes, fingers, head, brains, cara, dientes, piernas, cabeza, cuello, huesos, gueule, figure, dents, jambes, tete, cou, fresse, zahne, beine, kopf, genick, knochen, schadel, dentes, pernas, cabeca, pescoco, ossos, челюсть, зубы, ноги, кости, морду, шею",
    "WEAPON": "knife, knives, gun, guns, pistol, rifle, shotgun, crowbar, bat, baseball bat, hammer, axe, machete, bullet, bullets, rope, noose, bomb, brick, acid, razor, blade, cuchillo, pistola, navaja, couteau, fusil, flingue, messer, pistole, knarre, axt, faca, arma, нож, пистолет, топор",
    "STALK": "where you live, where you work, where you sleep, where he lives, where she lives, your address, your house, your home, your family, your kids, your car, which shift, watch your back, come for you, coming for you, find you, find him, find her, waiting for you, follow you home, donde vives, ou tu habites, wo du wohnst, onde voce mora, где ты живешь",
    "HARM": "ambulance, hospital, morgue, coffin, grave, funeral, wheelchair for life, your last, painful death, cancer, ambulancia, tumba, ataud, cercueil, krankenwagen, sarg, caixao, cova",
    # groups and what hate says of them
    "GROUP": """foreigners, foreigner, immigrants, immigrant, migrants, migrant, refugees, refugee, asylum seekers, muslims, muslim, jews, jewish, christians, catholics, protestants, hindus, sikhs, buddhists, atheists, gypsies, gypsy, roma, blacks, whites, asians, africans, arabs, latinos, mexicans, chinese, indians, pakistanis, poles, turks, kurds, gays, gay, lesbians, homosexuals, trans people, transgender*, queers, natives, aborigines, women, infidels, unbelievers, heathens, outsiders, aliens, minorities, ethnic*, disabled people, cripples, old people,
 extranjer*, inmigrantes, migrantes, refugiados, musulmanes, judios, gitanos, negros, moros, homosexuales, mujeres, etranger*, immigre*, migrants, refugies, musulmans, juifs, arabes, noirs, gitans, femmes, homosexuels, auslander*, einwanderer, zuwanderer, asylant*, asylbewerber, fremde, fremden, fremdlinge, migranten, fluchtling*, muslime, moslems, juden, zigeuner, schwarze, turken, schwule, frauen, estrangeir*, imigrantes, refugiados, muculmanos, judeus, ciganos, pretos, gays, mulheres, stranieri, immigrati, buitenlanders, immigranten,
 иностранц*, мигрант*, беженц*, мусульман*, евре*, цыган*, приезж*, 外国人, 移民, 難民, الأجانب, المهاجرين, اللاجئين, المهاجرون""",
    "PEOPLE": "folk, folks, people, peoples, faithful, believers, worshippers, women, men, families, children, kids, refugees, migrants, immigrants, tribe, race, lot, faith, religion, community, kind, sort, pueblo, gente, fieles, creyentes, gens, peuple, fideles, croyants, leute, menschen, personas, personnes, pessoas, volk, anhanger, glaubige, glaubigen, povo, fieis, crentes, fedeli, народ, люди",
    "SLUR": "subhuman*, untermensch*, towelhead*, raghead*, wetback*, gook*, chink*, spic, spics, kike*, nigger*, nigga*, faggot*, tranny, trannies, dyke*, paki, pakis, wog, wogs, coon, coons, goatfucker*, gypo*, pikey*, sudaca*, moro de mierda, bougnoule*, youpin*, negre*, bamboula*, kanake*, kanacke*, neger*, itaker*, judensau*, tschusch*, sandneger*, macaco*, жид, жиды, хач*, чурк*, черномаз*, チョン",
    "BEAST": """vermin, parasite*, rat, rats, cockroach*, roaches, animal, animals, beasts, pest, pests, scum, filth, plague, plagues, disease*, infestation*, leech*, savage*, barbarian*, garbage, trash, lice, louse, apes, monkey*, pigs, swine, dogs, maggots, locusts, virus*, cancer, tumour, tumor, infection, thieves, thief, criminals, criminal, rapists, murderers, terrorists, liars, invaders, invasion, hordes, swarm*, dirt, stain, curse, demons, devils, breed like, breeding, breed, infest*, contaminat*,
 ratas, ratones, parasitos, escoria, plaga, plagas, cucarachas, basura, bestias, animales, salvajes, ladrones, criminales, delincuentes, invasores, vermine, rats, cafards, parasites, racaille, dechets, animaux, sauvages, voleurs, ordures, peste, nuisibles, ungeziefer, ratten, schmarotzer, parasiten, abschaum, gesindel, dreck, mull, tiere, bestien, seuche, plage, kakerlaken, diebe, verbrecher, ratos, praga, pragas, parasitas, escoria, lixo, baratas, vermes, animais, ladroes, bandidos, invasores, parassiti, feccia, topi, ratten, ongedierte,
 паразит*, крыс*, тараканы, отброс*, мразь, сброд, зараза, нечисть, звери, 害虫, ゴキブリ, 寄生虫, ゴミ, 虫けら, حشرات, جرذان, طفيليات, صراصير""",
    "EXPEL": """deport*, expel*, thrown off, thrown out, throw them, kicked out, kick them, kick out, driven out, drive them out, drive them, chase them, chased out, banned from, ban all, ban them, banish*, round up, rounded up, round them up, get rid of, be rid of, lock them up, locked up, cattle wagon, cattle wagons, cattle truck*, freight wagon*, ghetto, sterili*, castrat*, exterminat*, eradicat*, eliminat*, annihilat*, wipe out, wiped out, wipe them, purge*, cleanse*, gas them, gassed, shoot them, hang them, hanged, burned, burn them, drown them, put down, keep out, keep them out, stay out, send them, send back, sent back, ship them, go home, go back, back where, where they came from, own country, not welcome, not belong, don t belong, no place for, never have let, let them in, never be allowed, not be allowed, should not be allowed, kept away, keep away, segregat*, separate buses, out of our, out of this country, refuse to serve, without them, cleaner without, better without, safer without, off our,
 fuera, expulsar*, expulsen, echarlos, echar a, deportar*, exterminar*, eliminarlos, largaos, que se vayan, no caben, dehors, expulser, degage*, renvoyer, exterminer, qu ils rentrent, chez eux, raus, hinaus, abschieben, abgeschoben, ausrotten, vertreiben, verjagen, weg mit, rauswerfen, expulsar, fora, fora daqui, deportados, exterminar, mandar embora, voltem para, via da qui, fuori, eruit, вон, выгнать, депортировать, убирайтесь, изгнать, истребить, 出て行け, 追い出せ, 帰れ, اطردوا, طرد, ارحلوا""",
    "LESS": "inferior blood, inferior race, inferior races, inferior people, inferior breed, inferior beings, inferior, less than human, not even human, not fully human, master race, white power, racial purity, pure blood, purity, traitor to, race traitor, born thieves, born liars, born criminals, all thieves, all liars, all criminals, by nature, in their blood, in their genes, cannot be trusted, can t be trusted, never trust, not people, ruin everything, ruining our, ruined this, destroying our, taking over, take over, overrun, stealing our, not brake for, sangre inferior, raza inferior, race inferieure, sang inferieur, minderwertig*, raca inferior, sangue inferior, недочеловек*, низшая раса, 劣等",
    "LOATHE": "hate, hates, hated, despise*, loathe*, detest*, disgust*, sicken*, spit, spits, spat, stink, stinks, smell, smells, reek, reeks, make me sick, cannot stand, can t stand, odio, odiamos, asco, apestan, escupir, deteste*, hais, puent, degout*, hasse, hassen, ekel*, ekelhaft*, stinken, verachte*, odeio, odiamos, nojo, fedem, ненавижу, воняют, 嫌い, 臭い, أكره",
    "THROW": "keep, keeps, kept, throw, throws, thrown, kick, kicks, kicked, chase, chased, drive, driven, ban, banned, bar, barred, force, forced, push, pushed, want, wants, get, lock, locked, leave, stay, ship, put, echar, saquen, sacar, quiten, mettez, virer, virez, jeter, werft, werfen, schmeisst, jagt, haltet, mandem, tirem, botar",
    "OUT": "out, off, away, gone, elsewhere, outside, home, fuera, lejos, dehors, hors, raus, hinaus, weg, fort, heim, fora, longe, вон, прочь",
    "DENY": "no rights, not deserve, don t deserve, do not deserve, does not deserve, never deserve, belong in, not belong, walk instead, back of the bus, not ride, no seat, have no place, has no place, not welcome, not equal, second class, not like us, second rate, lower class of",
    "ALLSUCH": "all of them, every one of them, every last one, the lot of them, them all, those people, these people, their kind, that sort, todos ellos, tous, sie alle, alle, todos, only real, real citizens, real locals, true citizens",
    # explicit
    "SEX": """porn*, xxx, nudes, horny, blowjob*, blow job, blow jobs, handjob*, hand job, rimjob*, masturbat*, wank, wanking, orgasm*, ejaculat*, cumshot*, cum, cumming, creampie*, gangbang*, gang bang, threesome*, foursome*, orgy, orgies, dildo*, vibrator*, buttplug*, bukkake, deepthroat*, bdsm, bondage, fetish*, hentai, milf*, camgirl*, cam girl, cam girls, sex cam, sex cams, webcam sex, escorts, escort girls, escort service, call girls, hooker*, prostitut*, brothel*, striptease*, stripping, topless, panties, thong, jizz, semen, sperm, erection, boner, hard on, clit*, vagina*, pussy, pussies, penis*, cock, cocks, dick, dicks, dick pic, dick pics, tits, titties, boobs, nipples, anal, oral sex, analsex, fellatio, cunnilingus, genitals, crotch, hookup, hookups, hook up, upskirt, groping, groped, grope, erotic*, sexting, sext, nympho*, incest, bestiality, casual sex, free sex, hot sex, sex tonight, want sex, have sex, had sex, having sex, just sex, sex in, sex with, sex video, sex videos, sex tape, sex chat, sex show, sex shop, sex toy, sex toys, sex now, fuck me, fuck her, fuck him, fuck all, fuck you hard, suck my, suck me, lick my, lick your, ride me, go down on, naked pics, nude pics, naked pictures, nude pictures, naked photos, nude photos, nude video, uncensored,
 sexo, desnuda, desnudas, desnudo, desnudos, follar, follar, follando, follo, cachond*, polla, coño, tetas, mamada, orgasmo, corrida, masturb*, porno*, putas, nudes, sexe, nue, nues, baise, baiser, chatte, nichons, branler, salope, porno*, nackt*, ficken, fick, geil, titten, muschi, schwanz, wichsen, sexvideo*, nacktbild*, blasen, bumsen, nua, nuas, pelad*, transar, foder, buceta, pau duro, gozar, peitos, punheta, tesao, safad*, gostosa, sesso, nuda, nudo, scopare, naakt*, neuken, seks*,
 секс*, порно*, голая, голые, голый, трах*, эротик*, интим, минет, ебать, セックス, エロ, 裸, ポルノ, 巨乳, オナニー, جنس, إباحية, عارية""",
    "SEXWEAK": "sex, sexy, nude, naked, undressed, undress, strip, stripper*, lingerie, underwear, bra, bare, condom*, lube, no strings, hot girls, hot girl, hot guys, hot women, hot singles, babes, babe, dirty, filthy night, wild night, couple seeks, seeks third, amateur*, wet, moan*, lick*, suck*, kinky, naughty, slutty, turned on, turn on, in bed, on your knees, thighs, thigh, butt, ass, booty, breasts, legs spread, spread, touch myself, touching, kiss*, came, climax, adult content, adult video, adult videos, explicit, cams, cam, webcam, onlyfans, escort, massage, used panties, in the back row, back row, back seat, in the toilet, into his pants, into her pants, dm me, message me, click here, caliente, cama, video, fotos, chaude, coquin*, heiss, scharf, quente, cama, molhad*, putaria",
    # who only reports, forbids or means something else
    "REPORT": """not tolerated, reported, report, reports, forbidden, prohibited, banned, ban on, zero tolerance, policy, policies, code of conduct, moderators, moderated, removed, deleted, police, complaint, complaints, hotline, exhibition, museum, survey, annex, training, pest control, vermin control, parade, campaign, awareness, rules, rule, guideline*, conference, study, lecture, film, theatre, prevention, harassment, discrimination, victims, witness*, fined, prosecuted, arrested, convicted, abusive language, hate speech, sexual harassment, asked for, is a crime, offence, offences, offense,
 prohibid*, denuncia*, no se tolera, museo, interdit*, signaler, musee, verboten, gemeldet, polizei, proibid*, denunci*, policia, запрещ*, полиция, 禁止""",
    "DOMAIN": "process, importer, validator, script, parser, fares, fare, feed, feeds, gtfs, dataset, agency, stop list, lock, server, file, files, csv, zip, json, api, dead end, deadline, rider survey, health, education, clinic",
}

#: The classes whose words are disguised above all.
DISGUISED = ("INSULT", "WEAK", "DEROG", "CURSE", "SLUR", "BEAST", "SEX")
BITS = {name: 1 << i for i, name in enumerate(CLASSES)}
#: What nations are called: filled from the groups given to the model.
NATION = 1 << len(CLASSES)
#: A word of NATION that names its people itself.
NATIONALS = 1 << len(CLASSES) + 1

#: Prior weights: (category, conditions that must all hold, weight); a condition is a class, ``2CLASS`` for two or more of its
#: words, ``CLASS<`` for a class that the sentence before has, or PERSON (someone is spoken to, spoken of or pointed at).
PRIORS: list[tuple[str, str, float]] = [
    ("abusive", "INSULT", 2.2), ("abusive", "INSULT PERSON", 2.2), ("abusive", "INSULT YOU", 0.8), ("abusive", "2INSULT", 1.5), ("abusive", "INSULT DEROG", 2.0), ("abusive", "INSULT CURSE", 1.0), ("abusive", "INSULT DISMISS", 1.5), ("abusive", "INSULT HURT", 1.0),
    ("abusive", "WEAK", 0.4), ("abusive", "WEAK YOU", 1.6), ("abusive", "WEAK DEROG", 1.6), ("abusive", "WEAK HURT", 0.6), ("abusive", "WEAK DISMISS", 1.5), ("abusive", "DEROG", 0.6), ("abusive", "DEROG YOU", 1.8), ("abusive", "2DEROG", 1.0), ("abusive", "2DEROG YOU", 1.5), ("abusive", "DEROG NAMED", 0.8), ("abusive", "CURSE YOU", 1.5),
    ("abusive", "DISMISS", 4.6), ("abusive", "STALK", 1.0), ("abusive", "STALK FIRST", 2.0), ("abusive", "STALK HURT", 2.0), ("abusive", "STALK WEAPON", 2.0), ("abusive", "HURT", 0.4), ("abusive", "HURT YOU", 1.2), ("abusive", "HURT HIM", 0.6), ("abusive", "HURT FIRST YOU", 1.6), ("abusive", "HURT FIRST HIM", 1.0), ("abusive", "HURT BODY", 1.8), ("abusive", "HURT BODY PERSON", 1.0),
    ("abusive", "HURT MODAL PERSON", 1.6), ("abusive", "WISH HURT", 2.4), ("abusive", "WISH HURT PERSON", 1.2), ("abusive", "HURT MODAL HIM", 1.4), ("abusive", "HURT MODAL NAMED", 1.4), ("abusive", "WEAPON PERSON", 1.0), ("abusive", "WEAPON FIRST YOU", 2.2), ("abusive", "HARM PERSON", 0.6), ("abusive", "HARM YOU HURT", 2.0), ("abusive", "HARM FIRST YOU", 1.0), ("abusive", "HARM MODAL PERSON", 0.8),
    ("abusive", "HATED", -4.5), ("abusive", "REPORT", -3.0), ("abusive", "DOMAIN", -0.7), ("abusive", "SEX", -2.0),
    ("hateful", "GROUP", 0.3), ("hateful", "SLUR", 4.8), ("hateful", "LESS", 2.0), ("hateful", "LESS GROUP", 3.4), ("hateful", "LESS ALLSUCH", 2.6), ("hateful", "BEAST GROUP", 4.6), ("hateful", "EXPEL GROUP", 4.4), ("hateful", "EXPEL BEAST", 4.6), ("hateful", "HURT GROUP", 2.4), ("hateful", "INSULT GROUP", 2.8), ("hateful", "DEROG GROUP", 2.8), ("hateful", "WEAK GROUP", 1.0), ("hateful", "CURSE GROUP", 2.4), ("hateful", "DISMISS GROUP", 3.5), ("hateful", "MODAL GROUP", 0.5), ("hateful", "ALLSUCH GROUP", 0.5), ("hateful", "LOATHE GROUP", 3.2), ("hateful", "LOATHE GROUP<", 4.4), ("hateful", "THROW OUT GROUP", 3.2), ("hateful", "DENY GROUP", 3.2), ("hateful", "DENY GROUP<", 2.0),
    ("hateful", "LESS GROUP<", 3.0), ("hateful", "BEAST GROUP<", 3.6), ("hateful", "EXPEL GROUP<", 3.2), ("hateful", "DISMISS GROUP<", 1.5), ("hateful", "INSULT GROUP<", 1.5), ("hateful", "DEROG GROUP<", 1.5), ("hateful", "REPORT", -3.0), ("hateful", "DOMAIN", -0.7),
    ("sexual", "SEX", 5.0), ("sexual", "2SEX", 2.0), ("sexual", "SEXWEAK", 0.9), ("sexual", "2SEXWEAK", 1.8), ("sexual", "SEX SEXWEAK", 1.5), ("sexual", "3SEXWEAK", 2.4), ("sexual", "INSULT", -0.6), ("sexual", "REPORT", -3.5), ("sexual", "DOMAIN", -0.7),
]
#: Prior weight of no class at all.
BIAS = -4.0
