from callweave.llm import residue as R


def brute(index, held):
    """By label, the weight that exemplars hold together of which the window holds enough: every exemplar is asked."""
    out = {}
    for label, own in R.exemplar_sets():
        common = own & held
        share = R.MENTIONED if label == "mention" else R.COVERED
        if sum(index.weight[t] for t in common) >= share * sum(index.weight[t] for t in own) - 1e-4:
            out.setdefault(label, set()).update(common)
    return {label: sum(index.weight[t] for t in common) for label, common in out.items() if common}


def test_postings_find_what_asking_every_exemplar_finds():
    for df, n in (({}, 0), ({t: len(t) * 40 for t in R.exemplar_tokens()} | {"0": 1000}, 1000)):
        index = R.Index(df, n)
        for _, own in R.exemplar_sets()[::3]:
            common = sorted(own, key=lambda t: (-index.weight[t], t))
            for k in (0, len(common) // 2, len(common) - 1):
                held = {*common[k:], "unknown"}
                got, want = index.matches(sorted(held)), brute(index, held)
                assert got.keys() == want.keys() and all(abs(got[x] - want[x]) < 0.01 for x in want)


def test_long_windows_first_gives_what_reading_in_order_gives():
    """The document rule, spelled out window by window."""
    index = R.Index({"the": 900, "is": 900, "0": 500}, 1000)
    parts = ["A call on sleep", "Home | About us", "The requested URL was not found on this server.", "We invite work on napping at sea, on rota design and on fatigue among tram drivers.", "Please try again later.", "Your content goes here.", "Papers are due in May."]
    for mask in range(1, 1 << len(parts)):
        chosen = [p for i, p in enumerate(parts) if mask >> i & 1]
        told, head, want = {"content": 0, "message": 0}, True, False
        for w in chosen:
            label, n = index.label(w)
            want |= label in ("slot", "filler")
            if label == "content" and head and not w.endswith("."):
                head = False
                continue
            head = head and label == "chrome"
            if label in told:
                told[label] += n
        want |= told["message"] > 0 and told["message"] >= told["content"]
        assert R.is_residue("\n".join(chosen), index) == want, chosen
