from corpusloom.operators import markdown


def test_all_media_and_the_truncated_flag():
    article = "\n\n".join(f"![i {i}](img/{i}.jpg)" for i in range(61)) + "\n\n[a](music/a.mp3)"
    assert len(markdown.media(article)) == 62
    items, truncated = markdown.harvest(article)
    assert len(items) == 61 and truncated == {"photo": True, "music": False}
    assert markdown.harvest(article, 61)[1] == {"photo": False, "music": False}
