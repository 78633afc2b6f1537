"""Rules for the parameters of information boxes."""

from __future__ import annotations

# Box ~ parameter ~ category ~ subcategory (- for none) ~ distance ~ reverse distance ~ sentence. [[T]] is the page,
# [[X]] the value; after ";;" stands another sentence for values that match the pattern before "=>".
RULES = r"""
infobox actor ~ occupation ~ PERSON ~ OCCUPATION ~ 20 ~ 60 ~ [[T]] worked as a [[X]]
infobox actor ~ domestic_partner ~ GENEALOGICAL ~ PARTNER ~ 10 ~ 10 ~ [[T]] lives with [[X]]
infobox actor ~ birthplace ~ PERSON ~ BIRTH ~ 30 ~ 70 ~ [[T]] was born in [[X]]
infobox actor ~ spouse ~ GENEALOGICAL ~ SPOUSE ~ 10 ~ 10 ~ [[T]] and [[X]] are married
infobox film ~ studio ~ FILM ~ LOCATION ~ 10 ~ 30 ~ [[T]] was filmed in [[X]]
infobox film ~ writer ~ FILM ~ WRITER ~ 10 ~ 10 ~ [[X]] wrote [[T]]
infobox film ~ director ~ FILM ~ DIRECTOR ~ 10 ~ 10 ~ [[X]] directed [[T]]
infobox film ~ editing ~ FILM ~ EDITOR ~ 10 ~ 10 ~ [[X]] edited [[T]]
infobox film ~ cinematography ~ FILM ~ CINEMATOGRAPHER ~ 10 ~ 10 ~ [[X]] did the cinematography for [[T]]
infobox film ~ music ~ FILM ~ COMPOSER ~ 10 ~ 10 ~ [[X]] composed the music for [[T]]
infobox film ~ starring ~ FILM ~ STAR ~ 10 ~ 10 ~ [[X]] appeared in [[T]]
infobox film ~ distributor ~ FILM ~ DISTRIBUTOR ~ 30 ~ 30 ~ [[T]] was distributed by [[X]]
infobox film ~ producer ~ FILM ~ PRODUCER ~ 10 ~ 10 ~ [[X]] produced [[T]]
infobox single ~ artist ~ MUSIC ~ ARTIST ~ 10 ~ 10 ~ [[T]] is a single by [[X]]
infobox single ~ writer ~ MUSIC ~ LYRICIST ~ 30 ~ 10 ~ [[X]] wrote [[T]]
infobox single ~ format ~ MUSIC ~ FORMAT ~ 30 ~ 60 ~ [[T]] was released in [[X]] format
infobox single ~ genre ~ MUSIC ~ GENRE ~ 20 ~ 70 ~ [[T]] is in the genre of [[X]]
infobox single ~ from album ~ MUSIC ~ ALBUM ~ 10 ~ 10 ~ [[T]] is a single from the album [[X]]
infobox single ~ label ~ MUSIC ~ LABEL ~ 30 ~ 50 ~ [[T]] was released by [[X]]
infobox broadcast ~ city ~ BROADCAST MEDIA ~ LOCATION ~ 50 ~ 60 ~ [[T]] broadcasts in [[X]]
infobox broadcast ~ affiliations ~ BROADCAST MEDIA ~ AFFILIATION ~ 30 ~ 50 ~ [[T]] is affiliated with [[X]]
infobox broadcast ~ licensee ~ BROADCAST MEDIA ~ - ~ 30 ~ 40 ~ [[X]] licenses [[T]]
infobox broadcast ~ sister_stations ~ BROADCAST MEDIA ~ AFFILIATION ~ 40 ~ 40 ~ [[T]] is a twin station of [[X]]
infobox broadcast ~ owner ~ BUSINESS ~ INVESTMENT ~ 10 ~ 40 ~ [[X]] owns [[T]]
infobox broadcast ~ former_affiliations ~ BROADCAST MEDIA ~ AFFILIATION ~ 30 ~ 30 ~ [[X]] was affiliated with [[T]]
infobox broadcast ~ location ~ BROADCAST MEDIA ~ LOCATION ~ 50 ~ 60 ~ [[T]]'s studio is located in [[X]]
infobox website ~ author ~ WEB ~ CREATOR ~ 10 ~ 10 ~ [[X]] created [[T]]
infobox website ~ owner ~ BUSINESS ~ INVESTMENT ~ 30 ~ 30 ~ [[X]] operates [[T]]
infobox software ~ author ~ TECHNOLOGY ~ DEVELOPER ~ 10 ~ 25 ~ [[X]] wrote [[T]]
infobox software ~ developer ~ TECHNOLOGY ~ DEVELOPER ~ 10 ~ 25 ~ [[X]] developed [[T]]
infobox television ~ director ~ BROADCAST MEDIA ~ DIRECTOR ~ 10 ~ 10 ~ [[T]] was directed by [[X]]
infobox television ~ writer ~ BROADCAST MEDIA ~ WRITER ~ 10 ~ 10 ~ [[T]] was written by [[X]]
infobox television ~ creator ~ BROADCAST MEDIA ~ CREATOR ~ 10 ~ 10 ~ [[T]] was created by [[X]]
infobox television ~ opentheme ~ BROADCAST MEDIA ~ MUSIC ~ 10 ~ 10 ~ [[T]]'s opening theme was [[X]]
infobox television ~ narrated ~ BROADCAST MEDIA ~ VOICE ~ 10 ~ 10 ~ [[T]] was narrated by [[X]]
infobox television ~ voices ~ BROADCAST MEDIA ~ VOICE ~ 20 ~ 20 ~ [[X]] was a voice on [[T]]
infobox television ~ starring ~ BROADCAST MEDIA ~ STAR ~ 10 ~ 10 ~ [[T]] starred [[X]]
infobox television ~ endtheme ~ BROADCAST MEDIA ~ MUSIC ~ 10 ~ 10 ~ [[T]]'s ending theme was [[X]]
infobox television ~ channel ~ BROADCAST MEDIA ~ CHANNEL ~ 30 ~ 70 ~ [[T]] was shown on [[X]]
infobox television ~ genre ~ BROADCAST MEDIA ~ GENRE ~ 20 ~ 60 ~ [[T]] belongs to the genre [[X]]
infobox television ~ theme_music_composer ~ BROADCAST MEDIA ~ MUSICIAN ~ 20 ~ 20 ~ [[T]]'s theme music was composed by [[X]]
infobox television ~ location ~ BROADCAST MEDIA ~ LOCATION ~ 40 ~ 70 ~ [[T]] was shot in [[X]]
infobox television ~ judges ~ BROADCAST MEDIA ~ STAR ~ 20 ~ 20 ~ [[X]] was a judge on [[T]]
infobox newspaper ~ newseditor ~ PRINT MEDIA ~ EDITOR ~ 10 ~ 10 ~ [[X]] is the news editor of [[T]]
infobox newspaper ~ chiefeditor ~ PRINT MEDIA ~ EDITOR ~ 10 ~ 10 ~ [[X]] is the chief editor of [[T]]
infobox newspaper ~ sportseditor ~ PRINT MEDIA ~ EDITOR ~ 10 ~ 10 ~ [[X]] is the sports editor of [[T]]
infobox newspaper ~ campuseditor ~ PRINT MEDIA ~ EDITOR ~ 10 ~ 10 ~ [[X]] is the campus editor of [[T]]
infobox newspaper ~ photoeditor ~ PRINT MEDIA ~ EDITOR ~ 10 ~ 10 ~ [[X]] is the photo editor of [[T]]
infobox newspaper ~ assoceditor ~ PRINT MEDIA ~ EDITOR ~ 10 ~ 10 ~ [[X]] is the associate editor of [[T]]
infobox newspaper ~ sister newspapers ~ PRINT MEDIA ~ RELATED ~ 40 ~ 40 ~ [[T]] and [[X]] are sister newspapers
infobox newspaper ~ staff ~ PRINT MEDIA ~ WRITER ~ 10 ~ 10 ~ [[X]] is a writer at [[T]]
infobox newspaper ~ founder ~ BUSINESS ~ EMPLOYEE ~ 10 ~ 10 ~ [[X]] founded [[T]]
infobox newspaper ~ campuschief ~ PRINT MEDIA ~ EDITOR ~ 10 ~ 10 ~ [[X]] is the campus chief of [[T]]
infobox newspaper ~ managingeditordesign ~ PRINT MEDIA ~ EDITOR ~ 10 ~ 10 ~ [[X]] is the managing design editor of [[T]]
infobox newspaper ~ editor ~ PRINT MEDIA ~ EDITOR ~ 10 ~ 10 ~ [[X]] is the editor of [[T]]
infobox newspaper ~ publisher ~ PRINT MEDIA ~ PUBLISHER ~ 10 ~ 10 ~ [[X]] is the publisher of [[T]]
infobox newspaper ~ opeditor ~ PRINT MEDIA ~ EDITOR ~ 10 ~ 10 ~ [[X]] is the opinion editor of [[T]]
infobox newspaper ~ maneditor ~ PRINT MEDIA ~ EDITOR ~ 10 ~ 10 ~ [[X]] is the managing editor of [[T]]
infobox newspaper ~ headquarters ~ BUSINESS ~ LOCATION ~ 50 ~ 50 ~ [[T]]'s headquarters is in [[X]]
infobox newspaper ~ owner ~ BUSINESS ~ INVESTMENT ~ 20 ~ 20 ~ [[X]] owns [[T]]
infobox musical artist ~ occupation ~ PERSON ~ OCCUPATION ~ 30 ~ 70 ~ [[T]] worked as a [[X]]
infobox musical artist ~ instrument ~ MUSIC ~ PERSONAL_INSTRUMENT ~ 10 ~ 50 ~ [[T]] makes music with their [[X]]
infobox musical artist ~ past_members ~ MUSIC ~ BAND_MEMBER ~ 10 ~ 10 ~ [[X]] was a member of [[T]]
infobox musical artist ~ notable_instruments ~ MUSIC ~ PERSONAL_INSTRUMENT ~ 20 ~ 60 ~ [[T]] makes music with their [[X]]
infobox musical artist ~ associated_acts ~ MUSIC ~ COLLABORATOR ~ 50 ~ 50 ~ [[T]] collaborated with [[X]]
infobox musical artist ~ origin ~ PERSON ~ BIRTH ~ 30 ~ 60 ~ [[T]] was born in [[X]]
infobox musical artist ~ genre ~ MUSIC ~ GENRE ~ 30 ~ 60 ~ [[T]]'s music belongs to the genre [[X]]
infobox musical artist ~ current_members ~ MUSIC ~ BAND_MEMBER ~ 10 ~ 10 ~ [[X]] is a member of [[T]]
infobox musical artist ~ label ~ MUSIC ~ LABEL ~ 20 ~ 30 ~ [[T]] was signed by [[X]]
infobox musical artist ~ spouse ~ GENEALOGICAL ~ SPOUSE ~ 10 ~ 10 ~ [[T]] and [[X]] are married
infobox television episode ~ director ~ BROADCAST MEDIA ~ DIRECTOR ~ 10 ~ 20 ~ [[X]] directed [[T]]
infobox television episode ~ writer ~ BROADCAST MEDIA ~ WRITER ~ 10 ~ 10 ~ [[X]] wrote [[T]]
infobox television episode ~ music ~ BROADCAST MEDIA ~ MUSICIAN ~ 20 ~ 20 ~ [[X]] wrote the music for [[T]]
infobox television episode ~ series ~ BROADCAST MEDIA ~ SERIES ~ 10 ~ 10 ~ [[T]] was an episode of [[X]]
infobox television episode ~ editor ~ BROADCAST MEDIA ~ EDITOR ~ 20 ~ 10 ~ [[X]] edited [[T]]
infobox television episode ~ producer ~ BROADCAST MEDIA ~ PRODUCER ~ 40 ~ 40 ~ [[X]] produced [[T]]
infobox television episode ~ photographer ~ BROADCAST MEDIA ~ CREW ~ 30 ~ 10 ~ [[X]] was the director of photography for [[T]]
infobox television episode ~ guests ~ BROADCAST MEDIA ~ ACTOR ~ 50 ~ 50 ~ [[X]] made a guest appearance on [[T]]
infobox magazine ~ company ~ PRINT MEDIA ~ PUBLISHER ~ 40 ~ 40 ~ [[X]] publishes [[T]]
infobox magazine ~ staff_writer ~ PRINT MEDIA ~ WRITER ~ 20 ~ 50 ~ [[X]] writes for [[T]]
infobox magazine ~ based ~ PRINT MEDIA ~ LOCATION ~ 50 ~ 70 ~ [[T]] is based in [[X]]
infobox magazine ~ previous_editor ~ PRINT MEDIA ~ EDITOR ~ 10 ~ 10 ~ [[X]] was the editor of [[T]]
infobox magazine ~ publisher ~ PRINT MEDIA ~ PUBLISHER ~ 40 ~ 40 ~ [[T]] publishes [[X]]
infobox magazine ~ editor ~ PRINT MEDIA ~ EDITOR ~ 10 ~ 10 ~ [[X]] is the editor of [[T]]
infobox book ~ author ~ LITERATURE ~ AUTHOR ~ 10 ~ 10 ~ [[X]] wrote [[T]]
infobox book ~ genre ~ LITERATURE ~ GENRE ~ 50 ~ 60 ~ [[T]] belongs to the genre [[X]]
infobox album ~ artist ~ MUSIC ~ ARTIST ~ 10 ~ 10 ~ [[X]] recorded [[T]]
infobox album ~ next album ~ MUSIC ~ RELATED_ALBUM ~ 40 ~ 40 ~ [[X]] was the group's next album after [[T]]
infobox album ~ last album ~ MUSIC ~ RELATED_ALBUM ~ 40 ~ 40 ~ [[X]] was the group's last album before [[T]]
infobox album ~ recorded ~ MUSIC ~ RECORDING_YEAR ~ 20 ~ 60 ~ [[T]] was recorded during [[X]]
infobox album ~ producer ~ MUSIC ~ PRODUCER ~ 40 ~ 50 ~ [[X]] produced [[T]]
infobox album ~ genre ~ MUSIC ~ GENRE ~ 30 ~ 70 ~ [[T]] belongs to the genre [[X]]
infobox album ~ released ~ MUSIC ~ RELEASE_DATE ~ 20 ~ 60 ~ [[T]] was released on [[X]]
infobox album ~ label ~ MUSIC ~ LABEL ~ 30 ~ 50 ~ [[X]] released [[T]]
infobox president ~ birth_place ~ PERSON ~ BIRTH ~ 40 ~ 50 ~ [[T]] was born in [[X]]
infobox president ~ occupation ~ PERSON ~ OCCUPATION ~ 30 ~ 80 ~ [[T]] worked as a [[X]]
infobox president ~ religion ~ PERSON ~ RELIGION ~ 20 ~ 70 ~ [[T]] is [[X]] ;; (ity)|(ism)|(lam)$ => [[T]]'s religion is [[X]]
infobox president ~ spouse ~ GENEALOGICAL ~ SPOUSE ~ 10 ~ 10 ~ [[T]] and [[X]] are married
"""


def parse_rules(text: str = RULES) -> dict[tuple[str, str], dict]:
    """Rules by (box, parameter): category, subcategory, distance, reverse, sentence and alternatives (pattern, sentence)."""
    out = {}
    for line in text.strip().splitlines():
        box, param, category, subcategory, near, far, told = line.split(" ~ ")
        sentence, *others = told.split(" ;; ")
        alternatives = [tuple(o.split(" => ", 1)) for o in others]
        out[box, param] = {"category": category, "subcategory": None if subcategory == "-" else subcategory, "distance": int(near), "reverse": int(far), "sentence": sentence, "alternatives": alternatives}
    return out


def rules_from_csv(lines: list[str]) -> str:
    """Rules as text from CSV lines: box, parameter, category, subcategory, distance, reverse, sentence.

    Rows without a sentence are left out and boxes are lower-cased. The lines are a parameter table, not data.
    """
    import csv

    out = []
    for row in csv.reader(lines):
        if len(row) >= 7 and row[6].strip() and row[4].strip().lstrip("-").isdigit():
            out.append(" ~ ".join([row[0].strip().lower(), row[1].strip(), row[2].strip(), row[3].strip() or "-", row[4].strip(), row[5].strip(), row[6].strip()]))
    return "\n".join(out)
