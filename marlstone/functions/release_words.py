"""Fixed values of release titles: the spellings of what a title can say about its release, as plain lists.

A hyphen in a spelling is a place where one separator (space, dot, hyphen, underscore) or none may stand; a space asks for one.
"""

from __future__ import annotations

CONTAINERS = "mkv mp4 avi mov wmv flv webm m4v mpg mpeg ts m2ts iso rmvb ogm".split()

#: For each attribute, its labels and their spellings.
QUALITY = {
    "2160p": ["2160p", "4k", "uhd", "3840x2160"],
    "1080p": ["1080p", "1080i", "fhd", "1920x1080"],
    "720p": ["720p", "1280x720"],
    "576p": ["576p"],
    "480p": ["480p"],
    "360p": ["360p"],
}
SOURCE = {
    "remux": ["bdremux", "remux"],
    "bluray": ["bluray", "blu-ray", "bd-rip", "brrip", "uhd-rip", "uhd-bd", "microhd"],
    "web-dl": ["web-dl", "amzn", "dsnp", "hmax", "atvp"],
    "webrip": ["webrip", "web-cap"],
    "hdtv": ["hdtv", "hdtvrip", "pdtv", "satrip"],
    "hdrip": ["hdrip"],
    "dvdrip": ["dvdrip"],
    "dvd": ["dvdr", "dvd"],
    "screener": ["dvdscr"],
    "vhs": ["vhsrip"],
    "cam": ["hdcam"],
    "telesync": ["hdts", "telesync"],
    "telecine": ["hdtc", "telecine"],
}
#: Only in capitals: they are words otherwise.
SOURCE_CAPITALS = {"cam": ["CAM"], "telesync": ["TS"], "telecine": ["TC"], "screener": ["SCR", "R5"], "web-dl": ["WEB", "NF"], "bluray": ["BD"]}
CODEC = {
    "h264": ["x-264", "h-264", "avc"],
    "hevc": ["x-265", "h-265", "hevc"],
    "av1": ["av1"],
    "xvid": ["xvid", "divx"],
    "vp9": ["vp9"],
    "mpeg2": ["mpeg-2"],
    "vc1": ["vc-1"],
}
AUDIO_CODEC = {
    "eac3": ["ddp", "dd+", "eac3", "e-ac-3", "e-ac3"],
    "ac3": ["ac-3", "dd"],
    "aac": ["aac"],
    "dts": ["dts", "dts-hd", "dts-hd-ma", "dts-x"],
    "truehd": ["truehd"],
    "atmos": ["atmos"],
    "flac": ["flac"],
    "opus": ["opus"],
    "mp3": ["mp3"],
    "pcm": ["pcm", "lpcm"],
}
CHANNELS = ["2.0", "5.1", "7.1"]
HDR = {"dv": ["dv", "dovi", "dolby-vision"], "hdr10+": ["hdr10+", "hdr10plus"], "hdr10": ["hdr10"], "hdr": ["hdr"], "hlg": ["hlg"], "sdr": ["sdr"]}
BIT_DEPTH = {"10": ["10-bit", "10-bits", "hi10", "hi10p"], "8": ["8-bit", "8-bits"]}

#: Words about an edition or a copy, which may also be words of a title.
FLAGS = [
    "repack", "proper", "rerip", "internal", "limited", "extended", "unrated", "director's cut", "directors cut", "director cut", "theatrical", "theatrical cut", "imax",
    "remastered", "uncut", "uncensored", "censored", "hc", "hardsub", "hardsubbed", "softsub", "softsubbed", "dubbed", "subbed",
]
#: Those that aren't words of titles.
FLAGS_ALWAYS = ["repack", "proper", "rerip", "internal", "remastered", "uncensored", "hc", "hardsub", "hardsubbed", "softsub", "softsubbed", "dubbed", "subbed", "director's cut", "directors cut", "theatrical cut"]
COMPLETE = ["complete", "completa", "completo", "batch", "integrale", "intégrale", "full-season", "full-series", "serie completa", "temporada completa", "complete series"]
COMPLETE_ALWAYS = ["batch", "integrale", "intégrale", "full-season", "full-series", "serie completa", "temporada completa", "complete series"]
EXTRA = ["ova", "ona", "oad", "ncop", "nced", "bdmv"]
DUAL = ["dual", "dual-audio", "dual-áudio", "dual-lang", "tri-audio", "doble-audio", "multi-audio", "multi-lang", "multi-langs", "multi-language", "multi-languages"]
MULTI = ["multi", "multi-sub", "multi-subs", "multiple-subtitle", "multiple-subtitles"]
EDITIONS = ["extended cut", "director's cut", "directors cut", "theatrical cut", "final cut", "unrated cut", "remastered", "imax"]

#: Words for seasons and episodes; a single letter stands right before its number.
SEASON = ["s", "t", "season", "seasons", "temporada", "temporadas", "saison", "saisons", "stagione", "staffel", "temp", "sezon"]
EPISODE = ["e", "ep", "episode", "episodio", "capítulo", "capitulo", "capítulos", "capitulos", "cap", "chapter", "folge"]
#: Words whose number holds the season too: Cap.312 is episode 12 of season 3.
SEASON_IN_NUMBER = ["cap", "capítulo", "capitulo", "capítulos", "capitulos"]
ORDINAL_ENDS = ["st", "nd", "rd", "th", "ª", "º", "°", "a"]
RANGE = ["al", "a", "to", "y"]
CJK_EPISODE = ["話", "话", "集"]

#: Languages that a release names beside its title: words, and codes in capitals.
LANGUAGE_WORDS = ["castellano", "latino", "español", "espanol", "vose", "vosi", "vostfr", "vosta", "subtitulado", "subtitulada", "subtitulados", "subtituladas", "doblado", "doblada"]
LANGUAGE_CAPITALS = ["SPA", "ENG", "LAT", "CAST", "ESP", "JAP", "JPN", "ITA", "GER", "FRE", "POR", "RUS"]
LANGUAGE_TAIL = ["spanish", "english", "japanese", "french", "german", "italian", "portuguese", "inglés", "ingles", "latino", "castellano", "español", "espanol", "dubbed", "subbed", "dual", "multi", "vose", "vo", "hd", "hq"]
SUBTITLE_WORDS = ["sub", "subs", "subtitle", "subtitles", "subtitulo", "subtitulos", "subtítulo", "subtítulos", "subtitulado", "subtitulada", "subtitulados", "subtituladas", "legendado", "softsub", "softsubs", "hardsub", "hardsubs", "multisub", "multisubs", "subbed"]
#: Marks of original audio with subtitles, and the language of these.
ORIGINAL = {"vose": "spanish", "vosi": "english", "vostfr": "french", "vosta": "english", "vo": None, "vos": None}
#: Before or after a word for subtitles.
SUBTITLE_LANGUAGES = {
    "spanish": ["esp", "español", "espanol", "castellano", "spanish", "cast", "es"],
    "latino": ["latino", "lat"],
    "english": ["eng", "english", "inglés", "ingles", "en"],
}

#: What sites write around titles. Strong words never belong to one; the others do, unless they come with more of them.
NOISE_STRONG = ["descargar", "download", "torrent", "gratis"]
NOISE_WEAK = ["ver", "online", "estreno", "free", "pelicula", "película", "peliculas", "películas", "serie", "series", "completa"]
NOISE_TAIL = ["online"]
SITE_WORDS = "torrent pct divx yts yify rarbg 1337x eztv ettv tgx estreno descarga peli cine hdolimpo".split()
SITE_ENDS = "com net org info biz xyz online site club tv cc ws top vip pro link live stream zone lol fun wtf ninja team one me to io es co lat mx ar cl pe pw li st is se ag ch nl ru si red app".split()

#: What speaks for anime, with the points that a confidence is made of (fixed values): from 40 on a title is anime, with 0.5 + points / 200.
ANIME_POINTS = {
    "known group": 60, "other group with number or checksum": 25, "checksum": 25, "number after a dash, no season": 30, "resolution in parentheses": 10, "number in brackets or after a sign": 15, "japanese script": 35,
    "extra": 20, "version": 25, "ten bits": 5, "japanese audio": 15, "particle": 10, "usual word": 15, "over sixty episodes without season": 15,
}
PARTICLES = ["no", "wo", "ga", "ni", "to", "wa"]
ANIME_WORDS = ["shippuden", "kaisen", "slayer", "hero academia", "isekai", "senpai", "sensei", "shoujo", "shounen", "gakuen", "monogatari", "densetsu", "no kyoujin"]

#: Words that are no title by themselves, when it is to be known whether one follows a group's name.
NOT_A_TITLE = ["season", "temporada", "episode", "episodio", "pack", "audio", "lang", "language", "languages", "full", "subs", "sub", "subtitle", "subtitles", "multiple", "cap", "capitulo", "capítulo"]
