"""Word lists. Longer ones (first names, speakers, places) are read from files, see ``read_word_list``."""

# Words that say little about the topic of a parliamentary speech.
TOPIC_STOP_WORDS = tuple("""
adat adott alap alapvető alapvetõ állam állami államtitkár általános anyag asszony azonnali benyújtott bizonyos
bizottság bizottsági cél cím derültség dolog dr. ebbõl egész elfogadás elhangzott eljárás elmúlt ellenszavazat elnök
előadó előző elõzõ előterjesztés elõterjesztés előterjesztő előtti első elsõ elõ errõl ember érdek eset év évi feladat
felszólalás fidesz figyelem fontos ház házszabály határozat határozati határozathozatal helyzet hivatala hét hölgy
hozzászólás hónap idő idõ időkeret igaz indítvány javaslat jelentkező jelentős jelentõs jelzés jegyző jó jog jogi
jogszabály kapcsolat kapcsolatos képviselő képviselői képviselőcsoport képviselőtárs képviselõtársaim kérdés kétperces
kéz kis kíván kör költségvetés költségvetési közbeszólás kormány következő következõ különbözõ lehetőség lehetõség
letelte magyar mai magyarország megkocogtatás megfelelő megfelelõ megoldás miniszter mód módosítás módosító mszp nagy
nap napirend napirendi oldal ország országgyûlés országgyûlési országgyűlés országgyűlési óra padsor parlament párt
perc perces politikai pont probléma program rendelkezés rendszer rész részletes rossz sor szám számú szavazás szavazat
százalék személy szempont szép szervezet szó szóló szöveg szükséges támogatás tag taps tartalom tekintet teljes
természetes terület tisztelt többség törvény törvényjavaslat törvénytervezet ügy új ülés ülésnap úr válasz válaszadás
válaszadó való vélemény vég vezető viszonválasz vita vonatkozó zaj zárószavazás lehetõ elsõsor jövõ fõ történõ fő
képviselõtárs õ részérõl
""".split())
